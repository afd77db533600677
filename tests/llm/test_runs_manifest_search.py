"""Periodic runs, the Merkle manifest and the multi-index search against brute force, and on odd rows."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle, multi_index, runs
from tidemark.llm.queries import QUERIES

ODD = [(1, None), (2, ""), (3, " \n\t "), (4, "one"), (4, "one"), (None, "no id here"), (5, "x" * 3000), (6, "word " * 2000), (7, "é日本🙂 ' \n a"), (20, "la le " * 30 + "end")]


@pytest.fixture(scope="module")
def odd(spark):
    """Nulls, empty and long texts, repeated rows, and extra columns with names that operators use themselves."""
    rows = [(i, t, "en" if i != 4 else None, None if i == 2 else "src1" if i != 5 else "src0", 0, "mine", 1.5, 7) for i, t in ODD]
    return spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint, node string, n double, pos int")


# -- periodic runs ----------------------------------------------------------------------------------------------------


def brute_runs(x, least, times):
    """All maximal stretches of each period, the smallest period of each stretch: by comparing words at each distance."""
    out = {}
    for q in range(1, len(x) // times + 1):
        i = 0
        while i + q < len(x):
            j = i
            while j + q < len(x) and x[j] == x[j + q]:
                j += 1
            if j > i and j - i + q >= max(least, times * q):
                out.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted(((i, n, q) for (i, n), q in out.items()), key=lambda r: (r[0], r[2]))


def some_words(r, letters, n):
    x = [r.choice(letters) for _ in range(n)]
    for _ in range(r.randint(0, 3)):
        a, p, m = r.randrange(len(x) + 1), r.randint(1, 12), r.randint(1, 70)
        x = x[:a] + (x[a:a + p] * 70)[:m] + x[a:]
    return x


def test_runs_match_comparison_of_words():
    r, many = random.Random(3), 0
    for _ in range(1500):
        x = some_words(r, range(r.choice([1, 2, 3, 8])), r.randint(0, 110))
        least, times = r.choice([24, 4, 9]), r.choice([3, 3, 2])
        got = [tuple(map(int, g)) for g in runs.runs_of(np.array([*x, 99], np.int64), least, times)]
        assert got == brute_runs(x, least, times)
        many += len(got)
    assert many > 3000


def expected_row(doc_id, text):
    words = (text or "").encode().split()
    n = len(words)
    h = zlib.crc32(str(doc_id).encode())
    if doc_id is not None and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    found = brute_runs(words, 24, 3)
    dropped = {i for s, length, q in found for i in range(s + q, s + length)}
    best = min(found, key=lambda f: (-f[1] * 10**9 // f[2], f[0], f[2])) if found else (None,) * 3
    sha = lambda b: hashlib.sha256(b).hexdigest()
    return (doc_id, len(found), *best, 1000 * best[1] // best[2] if found else None,
            sha("".join(f"{s},{length},{q}\n" for s, length, q in found).encode()), sha(b" ".join(w for i, w in enumerate(words) if i not in dropped)))


def test_runs_query_matches_brute_force(spark, tmp_path, odd):
    r = random.Random(9)
    docs = odd.select("doc_id", "text").collect() + [(k, " ".join(some_words(r, "abcde", r.randint(0, 90)))) for k in range(100, 400)]
    want = sorted(map(repr, (expected_row(d, t) for d, t in docs)))
    path = str(tmp_path)
    spark.createDataFrame([(*d, "en") for d in docs], "doc_id bigint, text string, runs string").write.parquet(f"{path}/documents.parquet")
    assert sorted(repr(tuple(row)) for row in QUERIES["op13_periodic_runs"](spark, path).collect()) == want
    assert sum(zlib.crc32(str(d).encode()) % 10 == 0 for d, _ in docs) > 10


def test_runs_query_on_the_test_table(spark, sf):
    texts = [(row["doc_id"], row["text"]) for row in spark.read.parquet(f"{sf}/documents.parquet").collect() if len(row["text"] or "") < 5000]
    got = {row["doc_id"]: tuple(row) for row in QUERIES["op13_periodic_runs"](spark, sf).collect()}
    assert sum(got[d][1] > 0 for d, _ in texts) > 5
    for d, t in texts:
        assert got[d] == expected_row(d, t)


def test_long_periodic_texts(odd):
    for x in ([1] * 200_000, [1, 2, 3, 4, 5, 6, 7] * 30_000, [v for k in range(5_000) for v in (1000 + k, *range(20))]):
        found = runs.runs_of(np.array([*x, 10**9], np.int64))
        assert len(found) == (0 if x[0] == 1000 else 1)
    assert runs.periodic_runs(odd.filter("false")).count() == 0


# -- the manifest -----------------------------------------------------------------------------------------------------


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def brute_manifest(rows, changed, fan=3):
    """Rows by list building: (doc_id, leaf, subroot, root, proof, folded, verified) of each."""
    value = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r, text: sha("".join(map(value, (r["doc_id"], r["source"], r["lang"], r["n_chars"], text))))

    def up(nodes):
        levels = [nodes]
        while len(levels[-1]) > 1:
            levels.append([sha("".join(levels[-1][i:i + fan])) for i in range(0, len(levels[-1]), fan)])
        return levels

    def path(levels, i):
        for nodes in levels[:-1]:
            a = i // fan * fan
            yield "".join(nodes[a:i]), "".join(nodes[i + 1:a + fan])
            i //= fan

    trees = {}
    for r in rows:
        trees.setdefault(r["source"], []).append((r["doc_id"] is not None, r["doc_id"] or 0, leaf(r, r["text"]), leaf(r, changed(r))))
    names = sorted(trees, key=lambda s: (s is not None, (s or "").encode()))
    built = {s: up([t[2] for t in sorted(trees[s])]) for s in names}
    top = up([built[s][-1][0] for s in names])
    out = []
    for s in names:
        for k, (known, doc_id, own, found) in enumerate(sorted(trees[s])):
            steps = [*path(built[s], k), *path(top, names.index(s))]
            for left, right in steps:
                found = sha(left + found + right)
            out.append((doc_id if known else None, own, built[s][-1][0], top[-1][0], sha("".join(a + b for a, b in steps)), found, found == top[-1][0]))
    return sorted(map(repr, out))


def no_breaks(r):
    return r["text"] if r["text"] is None or r["doc_id"] is None or zlib.crc32(str(r["doc_id"]).encode()) % 2 else r["text"].replace("\n", "")


def test_manifest_matches_brute_force(spark, tmp_path):
    r = random.Random(4)
    for n, sources in ((1, 1), (3, 1), (60, 40), (300, 2)):
        rows = [(k if r.random() < 0.95 else None, r.choice(["a\nb", None, "", "é"]) if k % 3 else f"text\n{k}", r.choice(["en", None]),
                 r.choice([None, *(f"s{j}" for j in range(sources - 1))]), r.choice([None, k])) for k in range(n)]
        path = f"{tmp_path}/{n}"
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
        docs.write.parquet(f"{path}/documents.parquet")
        got = sorted(repr(tuple(row)) for row in QUERIES["op12_merkle_manifest"](spark, path).collect())
        assert got == brute_manifest(docs.collect(), no_breaks)


@pytest.mark.parametrize(("fan", "levels"), [(2, 1), (3, 2), (4, 2)])
def test_manifest_with_other_shapes(spark, fan, levels):
    docs = spark.range(50).selectExpr("id as doc_id", "cast(id as string) as text", "'en' as lang", "case when id < 45 then 'a' else 'b' end as source", "id as n_chars")
    got = merkle.verified(merkle.manifest(docs, fan=fan, levels=levels))
    assert sorted(repr(tuple(row)) for row in got.collect()) == brute_manifest(docs.collect(), lambda r: r["text"], fan)


def test_manifest_on_odd_rows(odd):
    got = merkle.verified(merkle.manifest(odd)).collect()
    assert sorted(repr(tuple(row)) for row in got) == brute_manifest(odd.collect(), lambda r: r["text"])
    assert len(got) == len(ODD) and all(row["verified"] for row in got)
    assert merkle.verified(merkle.manifest(odd.filter("false"))).count() == 0


# -- the search -------------------------------------------------------------------------------------------------------


def brute_nearest(ids, x, most=20, every=20):
    out = {}
    for q in {i for i in ids if i is not None and i % every == 0}:
        score = np.array([(x[ids.index(q)].astype(float) * v.astype(float)).sum() if len(v) == len(x[ids.index(q)]) else -np.inf for v in x])
        order = [k for k in np.lexsort((ids, -score)) if ids[k] != q and score[k] > -np.inf]
        out[q] = [(ids[k], score[k]) for k in order[:most]]
    return out


def table(spark, ids, x):
    return spark.createDataFrame([(i, v.tolist(), "mine") for i, v in zip(ids, x, strict=True)], "vec_id bigint, embedding array<float>, score string")


def recall_of(found, want):
    got = {}
    for row in found.collect():
        got.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(got) == {q for q, w in want.items() if w}
    hits = 0
    for q, own in got.items():
        own.sort()
        assert [r for r, _, _ in own] == list(range(1, len(want[q]) + 1))
        assert own == [(k + 1, i, s) for k, (_, i, s) in enumerate(sorted(own, key=lambda o: (-o[2], o[1])))]
        scores = dict(want[q])
        assert all(abs(scores[i] - s) <= 1e-9 * max(1, abs(s)) for _, i, s in own if i in scores)
        hits += sum(i in scores for _, i, _ in own)
    return hits / max(1, sum(map(len, want.values())))


@pytest.mark.parametrize("shape", ["even", "leaning", "lengths", "clusters"])
def test_search_recall(spark, shape):
    r = np.random.RandomState(5)
    x = r.standard_normal((1500, 24))
    if shape == "leaning":
        x = x * 0.3 + 2
    if shape == "lengths":
        x *= np.exp(r.standard_normal((1500, 1)) * 1.5)
    if shape == "clusters":
        x = x * 0.1 + np.repeat(r.standard_normal((30, 24)), 50, axis=0)
    x = x.astype(np.float32)
    ids = list(range(1500))
    assert recall_of(multi_index.nearest(table(spark, ids, x)), brute_nearest(ids, x)) >= 0.9


def test_search_among_copies_and_in_small_cells(spark, monkeypatch):
    """A third of the rows is one vector; cells are cut on both sides."""
    monkeypatch.setattr(multi_index, "ROWS", 64)
    monkeypatch.setattr(multi_index, "QUERIES", 4)
    monkeypatch.setattr(multi_index, "AT_ONCE", 3)
    r = np.random.RandomState(6)
    x = r.standard_normal((600, 16)).astype(np.float32)
    x[::3] = x[0]
    ids = list(range(600))
    assert recall_of(multi_index.nearest(table(spark, ids, x)), brute_nearest(ids, x)) >= 0.9


def test_search_on_odd_rows(spark):
    good = [(0, [1.0, 0.0]), (20, [1.0, 0.0]), (20, [1.0, 0.0]), (3, [-1.0, 0.5]), (40, [1.0, 0.0, 0.0]), (7, [0.0, 2.0, 1.0])]
    bad = [(60, None), (80, []), (100, [0.0, -0.0]), (120, [float("nan"), 1.0]), (140, [float("inf"), 1.0]), (160, [None, 1.0]), (None, [1.0, 1.0])]
    rows = spark.createDataFrame([(i, v, 1) for i, v in good + bad], "vec_id bigint, embedding array<double>, key int")
    got = sorted(tuple(row) for row in multi_index.nearest(rows).collect())
    assert got == [(0, 1, 20, 1.0), (0, 2, 3, -1.0), (20, 1, 0, 1.0), (20, 2, 3, -1.0), (40, 1, 7, 0.0)]
    assert multi_index.nearest(rows.filter("false")).count() == 0
    assert multi_index.nearest(rows.filter("vec_id = 3")).count() == 0


def test_pigeonhole_probing_finds_every_code_within_the_radius():
    r = random.Random(2)
    for _ in range(300):
        m, width, radius = r.randint(1, 5), r.randint(1, 6), r.randint(0, 20)
        a, b = (np.array([r.randrange(1 << width) for _ in range(m)]) for _ in range(2))
        apart = [int(p ^ q).bit_count() for p, q in zip(a, b, strict=True)]
        if sum(apart) <= radius:
            assert any(d <= multi_index.flips(radius, i, m) for i, d in enumerate(apart))
    assert sorted(multi_index.near_prefixes(5, 3, 1)) == [1, 4, 5, 7]
    assert multi_index.near_prefixes(0, 0, 2) == [0]
