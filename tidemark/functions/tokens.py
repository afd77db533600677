"""The tokeniser as a table function, for SQL text that calls it with LATERAL.

Batch jobs use ``operators.logs.words`` instead, which stays inside the JVM.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

from pyspark.sql import SparkSession
from pyspark.sql.functions import udtf

#: Letters and digits of any script: word characters but for the underscore.
_WORD = re.compile(r"[^\W_]+")


def split_words(text: str) -> Iterable[str]:
    return _WORD.findall(text.lower())


def register_tokens(spark: SparkSession, name: str, tokenise: Callable[[str], Iterable[str]] = split_words) -> None:
    """Register ``name(text) -> word``. Any tokeniser of whole texts can be passed."""

    class Tokens:
        def eval(self, text: str):
            for word in tokenise(text or ""):
                yield (word,)

    spark.udtf.register(name, udtf(Tokens, returnType="word string"))
