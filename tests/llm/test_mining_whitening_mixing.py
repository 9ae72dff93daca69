"""Phrase mining, whitening and mixing against brute force, on the smallest tables and on awkward rows."""

import re
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tests.conftest import SF001
from vaultspark.llm import mixing, phrases, queries, whitening
from vaultspark.llm.common import read

CLASH = "n long, rank int, phrase string, size long, target double, copies int, _x string, _row int, k int, h long, component int"


def _frame(spark, rows, ddl, clash=CLASH):
    extra = [None] * len(clash.split(", "))
    return spark.createDataFrame([(*r, *extra) for r in rows], f"{ddl}, {clash}")


# ---------------------------------------------------------------- phrases

def _mined(rows, least=10, top=2000, longest=3, overlap=50):
    counts, total = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", text):
            w = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(w)
            for k in range(1, longest + 1):
                counts[lang].update(tuple(w[i:i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, f in counts.items():
        known = {p: a for p, a in f.items() if len(p) > 1 and a >= least}
        ranked = []
        for p, a in known.items():
            if any(len(q) > len(p) and 100 * b >= overlap * a and any(q[i:i + len(p)] == p for i in range(len(q) - len(p) + 1))
                   for q, b in known.items()):
                continue
            score, _, left, right = min((10 ** 6 * a * a // (f[p[:c]] * f[p[c:]]), c, f[p[:c]], f[p[c:]]) for c in range(1, len(p)))
            ranked.append((-score, -a, " ".join(p).encode(), left, right))
        out += [(lang, n + 1, p.decode(), -a, left, right, total[lang], -s)
                for n, (s, a, p, left, right) in enumerate(sorted(ranked)[:top])]
    return sorted(out)


TEXTS = [
    ("en", "The old Mill. the old mill, THE OLD MILL! " * 6), (None, "one two\tthree  one two three\none two " * 8), ("und", "One two. " * 7),
    ("en", None), ("en", ""), ("fr", "été à é, É à " * 12), ("fr", "x\x0bx x\x0cx x\rx " * 9), ("en", "a " * 40), ("en", "a b " * 9), ("de", "once only"),
    ("es", ". , ;"), ("en", " the  \x1cold\x1c " * 11), ("en", "The old Mill. the old mill, THE OLD MILL! " * 6),
]


def test_phrases_match_brute_force(spark):
    df = _frame(spark, TEXTS, "lang string, text string").repartition(3)
    for options in ({}, {"fraction": 0.0}, {"filter_bits": 64}):  # nothing proposed; a filter that holds everything
        assert sorted(map(tuple, phrases.mine_phrases(df, **options).collect())) == _mined(TEXTS)
    got = phrases.mine_phrases(df, max_words=4, min_count=5, top=3, overlap=80).collect()
    assert sorted(map(tuple, got)) == _mined(TEXTS, 5, 3, 4, 80)
    assert phrases.mine_phrases(df.limit(0)).count() == 0


def test_border_failures_lead_to_further_passes(spark):
    df = spark.createDataFrame([("en", "w1 w2 w3 w1 w2 w3. " * 6)], "lang string, text string")
    found, passes = phrases.frequent_phrases(df, fraction=0.0)
    assert passes == 3  # words, then pairs of them, then triples of those
    whole, once = phrases.frequent_phrases(df, fraction=1.0)
    assert once == 1 and sorted(map(repr, whole.collect())) == sorted(map(repr, found.collect()))


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])


def _counts(rows):
    out = Counter()
    for chunk in phrases._chunks(iter([_batch(rows)]), 2):
        for part in phrases._count(*chunk, 3, 5, None, None, True):
            for r in part.to_pylist():
                out[tuple(v for k, v in r.items() if k != "a") if r["k"] else r["lang"]] += r["a"]
    return out


def test_long_texts_are_counted_in_blocks(monkeypatch):
    rng = np.random.default_rng(3)
    words = np.array([f"w{i}" for i in range(30)] + ["x,", "y.", "z" * 40, "\n"])
    texts = [("en", " ".join(words[rng.integers(0, len(words) - 4 * (i % 2), 4000)])) for i in range(3)]
    texts += [("en", "v" * 5000 + " v"), ("en", "u v" + " " * 900 + "u v"), ("fr", "")]
    whole = _counts(texts)
    for size in (64, 1000):
        monkeypatch.setattr(phrases, "CHUNK", size)
        assert _counts(texts) == whole


def test_scores_beyond_64_bits_are_exact(spark):
    a, left, right = 3_000_000_000_001, 3_000_000_000_019, 4_000_000_000_003
    found = spark.createDataFrame([(2, [7, 8], a), (1, [7], left), (1, [8], right)], "k int, w array<long>, a long")
    assert [tuple(r) for r in phrases.scored(found).collect()] == [(2, [7, 8], a, left, right, 10 ** 6 * a * a // (left * right))]


def test_words_that_share_a_hash_are_found(spark, monkeypatch):
    """A chunk keeps two words of one hash apart; the miner then takes the next seed."""
    words = phrases._words

    def same(data, lang, seeds):
        h, begins, ends, joined = words(data, lang, seeds)
        return [(ends - begins).astype(np.uint64) if seed == 0 else x for x, seed in zip(h, seeds)], begins, ends, joined

    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(phrases, "_words", same)
        parts = [p for chunk in phrases._chunks(iter([_batch([("en", "aa bb aa")])]), 2) for p in phrases._count(*chunk, 3, 0, None, None, True)]
    rows = [r for p in parts for r in p.to_pylist() if r["k"] == 1]
    assert sorted((r["word"], r["a"]) for r in rows) == [("aa", 2), ("bb", 1)] and len({r["w1"] for r in rows}) == 1
    added = [r for p in phrases._add_up(iter(parts), 3, 1) for r in p.to_pylist()]
    assert sum(r["a"] for r in added if r["k"] == phrases.CLASH) == 1
    count, seeds = phrases.count_phrases, []

    def clashing(docs, max_words, least, parts, seed=0, *args, **named):
        seeds.append(seed)
        out = count(docs, max_words, least, parts, seed, *args, **named)
        return out.withColumn("k", F.when(F.lit(seed == 0 and not named), phrases.CLASH).otherwise(F.col("k")))

    monkeypatch.setattr(phrases, "count_phrases", clashing)
    df = spark.createDataFrame([("en", "a b a b " * 10)], "lang string, text string")
    found, _ = phrases.frequent_phrases(df, max_words=2)
    assert seeds[:4] == [0, 0, 1, 1] and {r["a"] for r in found.where("k = 1").collect()} == {20}


# ---------------------------------------------------------------- whitening

def _exact_fit(vectors, scale=256):
    width = max((len(v) for v in vectors), default=0)
    x = [tuple(int(np.floor(scale * float(np.float32(c)))) for c in v) + (0,) * (width - len(v)) for v in vectors]
    fit = sorted(set(x))
    n = len(fit)
    sums = [sum(r[d] for r in fit) for d in range(width)]
    v = np.array([[float(Fraction(sum((n * r[d] - sums[d]) * (n * r[e] - sums[e]) for r in fit), n ** 3)) for e in range(width)] for d in range(width)])
    return x, n, sums, v


def _whitening_agrees(rows, data, components=4):
    x, n, sums, v = _exact_fit([c for _, c in data])
    e, u = np.linalg.eigh(v)
    e, u = e[::-1], u[:, ::-1]
    want = defaultdict(list)
    for (i, _), r in zip(data, x):
        z = [n * a - s for a, s in zip(r, sums)]
        want[i].append((sum(q * q for q in z), np.array(z, float) / n @ u[:, :components] / np.sqrt(e[:components])))
    got = defaultdict(dict)
    for r in rows:
        assert r["n"] == n and r["identity_error"] <= 1e-9
        assert abs(r["explained"] - e[r["component"] - 1] / np.trace(v)) <= 1e-9 * r["explained"]
        got[r["vec_id"], r["deviation"]].setdefault(r["component"], []).append(r["whitened"])
    assert {k: len(next(iter(c.values()))) for k, c in got.items()} == Counter((i, d) for i, many in want.items() for d, _ in many)
    sign = {}
    for i, many in want.items():
        for d, w in many:
            for k in range(components):
                for value in got[i, d][k + 1]:
                    if abs(w[k]) > 1e-6:
                        assert sign.setdefault(k, np.sign(w[k] * value)) * value == pytest.approx(w[k], rel=1e-7, abs=1e-9)


def test_whitening_matches_exact_arithmetic(spark):
    rng = np.random.default_rng(6)
    spread = np.array([3, 2, 1.2, 0.7, 0.3, 0.1])
    data = [(i, [float(c) for c in rng.normal(size=6) * spread + 5]) for i in range(90)]
    data += [(200 + i, data[0][1]) for i in range(30)] + [(1, data[1][1]), (None, data[2][1]), (300, [1.0, -2.0])]
    bad = [(400, None), (401, [None] + [1.0] * 5), (402, [float("nan")] * 6), (403, [float("inf")] * 6)]
    df = _frame(spark, data + bad, "vec_id long, embedding array<float>").repartition(4)
    _whitening_agrees(whitening.whiten(df).collect(), data)
    assert whitening.whiten(df.limit(0)).count() == 0
    kept = whitening.whiten(df, components=2, carry=("vec_id", "rank", "n"))
    assert kept.columns == ["vec_id", "rank", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    assert kept.count() == 2 * len(data)


def test_whitening_of_large_entries(spark):
    rng = np.random.default_rng(7)
    data = [(i, [float(c) for c in np.float32(rng.normal(size=3) * [4e13, 1e13, 2.0] + 1e13)]) for i in range(40)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>")
    x, n, sums, _ = _exact_fit([c for _, c in data])
    got = {r["vec_id"]: int(r["deviation"]) for r in whitening.whiten(df, components=1).collect()}
    assert got == {i: sum((n * a - s) ** 2 for a, s in zip(r, sums)) for (i, _), r in zip(data, x)}
    with pytest.raises(Exception, match="too large"):
        whitening.whiten(spark.createDataFrame([(1, [1e30]), (2, [1.0])], "vec_id long, embedding array<float>")).collect()


def test_whitening_without_variance(spark):
    flat = spark.createDataFrame([(i, [1.0, float(i % 3), 2.0]) for i in range(9)], "vec_id long, embedding array<float>")
    assert {r["component"] for r in whitening.whiten(flat).collect()} == {1}
    for rows in ([(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, []), (2, [])], [(1, None)]):
        assert whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).count() == 0


def test_whitening_query(spark):
    data = [(r["vec_id"], r["embedding"]) for r in read(spark, SF001, "embeddings").collect()]
    rows = queries.op12_whitening(spark, SF001).collect()
    assert len(rows) == 4 * len(data)
    _whitening_agrees(rows, data)


# ---------------------------------------------------------------- mixing

def _targets(sizes, weights=(5, 2, 1), cap=3):
    w = {s: weights[i % len(weights)] for i, s in enumerate(sorted(sizes, key=lambda s: (s is None, s or "")))}
    stopped, total = set(), sum(sizes.values())
    while True:
        rest = total - sum(cap * sizes[s] for s in stopped)
        shares = sum(w[s] for s in w if s not in stopped)
        got = {s: Fraction(cap * sizes[s]) if s in stopped else Fraction(rest * w[s], shares) for s in w}
        more = {s for s in w if s not in stopped and got[s] > cap * sizes[s]}
        if not more:
            return got
        stopped |= more


def _mix_agrees(got, rows):
    sizes, longest, taken = Counter(), Counter(), Counter()
    for _, source, text in rows:
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        sizes[source] += n
        longest[source] = max(longest[source], n)
    want = _targets(sizes)
    assert len(got) == len(rows)
    by_id = {i: (s, len(re.findall(r"[^\x20\x09-\x0D]+", t or ""))) for i, s, t in rows}
    for r in got:
        source, size = by_id[r["doc_id"]]
        assert (r["size"], r["source_size"]) == (size, sizes[source]) and r["target"] == pytest.approx(float(want[source]))
        assert 0 <= r["copies"] <= 3
        taken[source] += r["copies"] * r["size"]
    for s, t in want.items():
        assert abs(taken[s] - t) <= max(1, longest[s])
    return taken


def test_mixing_hits_its_targets(spark):
    rng = np.random.default_rng(8)
    names = ["b", "a", "é", "\U0001f600", "", None, "c"]
    rows = [(i, names[min(int(rng.integers(0, 12)), 6)], " ".join(["w"] * int(rng.integers(0, 60) ** 2 / 20))) for i in range(600)]
    rows += [(1000, "a", None), (1001, "none", ""), (1002, None, "w " * 30000), (1003, "tiny", "one"), (1004, "c", "\t\n x y z ")]
    df = _frame(spark, rows, "doc_id long, source string, text string").repartition(5)
    got = mixing.mix_sources(df).select("doc_id", "size", "source_size", "target", "copies").collect()
    _mix_agrees(got, rows)
    again = mixing.mix_sources(df.repartition(2)).select("doc_id", "copies").collect()
    assert {tuple(r) for r in again} == {(r["doc_id"], r["copies"]) for r in got}
    other = mixing.mix_sources(df, seed="other").collect()
    assert {(r["doc_id"], r["copies"]) for r in other} != {(r["doc_id"], r["copies"]) for r in got}
    out = mixing.mixed(df)
    assert out.columns == ["doc_id", "source", "text", "n", "rank", "phrase", "_x", "_row", "k", "h", "component", "copy"]
    assert Counter(r["doc_id"] for r in out.collect()) == Counter({r["doc_id"]: r["copies"] for r in got if r["copies"]})


def test_mixing_of_awkward_tables(spark):
    ddl = "doc_id long, source string, text string"
    assert mixing.mix_sources(spark.createDataFrame([], ddl)).count() == 0
    empty = mixing.mix_sources(spark.createDataFrame([(1, "a", ""), (2, None, None)], ddl)).collect()
    assert [(r["size"], r["target"], r["copies"]) for r in empty] == [(0, 0.0, 0)] * 2
    same = mixing.mix_sources(spark.createDataFrame([(None, "a", "x y")] * 30 + [(2, "b", "z " * 40)], ddl)).collect()
    assert sum(r["copies"] * r["size"] for r in same if r["doc_id"] is None) == pytest.approx(100 * 5 / 7, abs=2)
    one = mixing.mix_sources(spark.createDataFrame([(1, "a", "x y z")], ddl)).collect()
    assert [(r["target"], r["copies"]) for r in one] == [(3.0, 1)]


def test_offsets_are_uniform(spark):
    got = spark.range(2000).select(mixing.start(F.col("id").cast("string"), "s").alias("u")).collect()
    assert np.allclose(np.quantile([r["u"] for r in got], [0.1, 0.5, 0.9]), [0.1, 0.5, 0.9], atol=0.05)


def test_mixing_query(spark):
    docs = [(r["doc_id"], r["source"], r["text"]) for r in read(spark, SF001, "documents").collect()]
    got = queries.op13_mixing(spark, SF001).withColumn("copies", F.when(F.col("size") > 0, F.col("taken") / F.col("size")).otherwise(0))
    _mix_agrees(got.collect(), docs)
