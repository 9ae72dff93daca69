"""Operators against brute force, on the smallest tables and on awkward rows: nulls, empty and long texts, ties,
repeated rows, empty tables, columns with clashing names."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tests.conftest import SF001
from vaultspark.llm import decontam, linear, linededup, packing, pii, quality, queries, sharding, simhash, topk, toxicity, warc
from vaultspark.llm.common import read

LINE = "This very line of more than forty characters is shared"
DOCS = [
    (1, f"{LINE}\nalpha one"), (2, f"  {LINE.upper()}\t\nbeta two"), (3, f"{LINE}\ngamma\n{LINE}"), (4, LINE), (5, f"{LINE}\n\ndelta"),
    (6, None), (7, ""), (7, ""), (None, f"{LINE}\nno id"), (8, "word " * 30000), (9, "x" * 50000), (10, "É" * 45 + "\né"),
    (10, "É" * 45 + "\né"), (11, "mail me at a.b@c.example or +1 (22) 333-4455, card 4111 1111 1111 1111 host 10.0.0.1"),
]
CLASH = ("size long, shard int, slot long, _part int, _id long, h1 long, key string, fp long, bin int, part int, score double, "
         "_text string, _y int, item_id long, h long, n_lines long, _row long")


@pytest.fixture(scope="module")
def docs(spark):
    extra = [None] * len(CLASH.split(", "))
    return spark.createDataFrame([(*d, *extra) for d in DOCS], f"doc_id long, text string, {CLASH}")


@pytest.fixture(scope="module")
def documents(spark):
    return read(spark, SF001, "documents")


def _sorted(rows):
    return sorted(rows, key=repr)


def test_shards_are_contiguous_and_even(spark, docs):
    got = sorted(sharding.shard_documents(docs, 3).collect(), key=lambda r: (r["shard"], r["slot"]))
    assert len(got) == len(DOCS)
    ids = [-1 if r["doc_id"] is None else r["doc_id"] for r in got]
    assert ids == sorted(ids)
    by = defaultdict(list)
    for r in got:
        by[r["shard"]].append(r["slot"])
    assert all(s == list(range(len(s))) for s in by.values())
    total, largest = sum(r["size"] for r in got), max(r["size"] for r in got)
    for k in range(3):
        assert abs(sum(r["size"] for r in got if r["shard"] == k) - total / 3) <= largest
    assert {(r["size"], r["text_crc32"]) for r in got} == {
        (len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for _, t in DOCS}
    assert sharding.shard_documents(docs.limit(0)).count() == 0


def _key(line):
    return re.sub("[A-Z]", lambda m: m[0].lower(), line.strip(" \t\n\x0b\x0c\r"))


def _line_dedup(rows):
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            if len(_key(x)) >= 40:
                held[_key(x)].add(-1 if i is None else i)
    lost = {k: max(v) for k, v in held.items() if len(v) >= 5}
    out = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if lost.get(_key(x)) in (None, -1 if i is None else i)]
        out.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    return out


def test_line_dedup(docs):
    got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in linededup.dedup_lines(docs).collect()]
    assert _sorted(got) == _sorted(_line_dedup(DOCS))
    with pytest.MonkeyPatch.context() as patch:  # no line is hot: all runs are streamed in their ranges
        patch.setattr(linededup, "HOT_SEEN", 10 ** 9)
        got = [(r["doc_id"], r["n_lines"], r["n_dropped"], r["text"] or "") for r in linededup.dedup_lines(docs).collect()]
    assert _sorted(got) == _sorted(_line_dedup(DOCS))
    named = docs.select("doc_id", "text", F.lit(5).alias("_id"), F.lit(6).alias("_text_hash"), F.lit(7).alias("dropped"))
    assert {tuple(r)[1:4] for r in linededup.dedup_lines(named).collect()} == {(5, 6, 7)}
    assert linededup.dedup_lines(docs.limit(0)).count() == 0


def test_line_runs_are_streamed_in_sorted_ranges(spark, documents):
    """A range exchange, a sort and windows over it; the rows meet no hash exchange by line."""
    mode = spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple")
    plan = linededup.line_drops(documents)._jdf.queryExecution().explainString(mode)
    assert "rangepartitioning(h1" in plan and "Sort [h1" in plan and "Window" in plan
    assert "hashpartitioning(h1" not in plan and "SortMergeJoin" not in plan


def test_keep_bitmaps_leave_full_words_out(spark):
    long = "\n".join([LINE if i in (3, 200) else f"line {i}" for i in range(400)])
    df = spark.createDataFrame([(i, LINE) for i in range(2, 7)] + [(1, long)], "doc_id long, text string")
    row = {r["_id"]: r for r in linededup.line_drops(df).collect()}[1]
    assert row["n_dropped"] == 2
    assert [(w["word"], w["bits"]) for w in row["kept"]] == [(0, ~(1 << 3)), (3, ~(1 << (200 - 192)))]


def _components(rows, bits=4):
    fps = {t: simhash.fingerprint(t) for _, t in rows}
    values = sorted(set(fps.values()))
    u = np.array(values, np.int64).view(np.uint64)
    root = {v: v for v in values}

    def find(v):
        while root[v] != v:
            v = root[v]
        return v

    for i, row in enumerate(u):
        for j in np.flatnonzero(np.bitwise_count(u ^ row) <= bits):
            root[find(values[i])] = find(values[j])
    low = defaultdict(list)
    for i, t in rows:
        if i is not None:
            low[find(fps[t])].append(i)
    return [(i, fps[t], min(low[find(fps[t])], default=None)) for i, t in rows]


def test_simhash_matches_all_pairs(docs, documents):
    for df in (docs, documents):
        rows = [(r["doc_id"], r["text"]) for r in df.select("doc_id", "text").collect()]
        got = [tuple(r) for r in simhash.near_duplicates(df).collect()]
        assert _sorted(got) == _sorted(_components(rows))
    assert simhash.near_duplicates(docs.limit(0)).count() == 0


def test_golay_keys_meet_within_four_bits():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2 ** 63, 300, dtype=np.int64)
    other = base.copy()
    for i in range(len(base)):
        for b in rng.choice(64, rng.integers(0, 5), replace=False):
            other[i] ^= np.int64(np.uint64(1 << int(b)).view(np.int64))
    for a, b in zip(base, other):
        assert set(simhash.golay_keys(np.array([a]))[0]) & set(simhash.golay_keys(np.array([b]))[0])


def test_large_groups_are_linked_in_blocks(spark):
    rng = np.random.default_rng(2)
    flips = {int(np.uint64((1 << int(a)) | (1 << int(b))).view(np.int64)) for a, b in rng.integers(0, 64, (300, 2))}
    fps = spark.createDataFrame([(v,) for v in flips], "fp long")
    links = simhash.fingerprint_links(fps, 4, group_rows=16)
    from vaultspark.llm.components import connected_components
    parts = connected_components(links).collect()
    assert len(parts) == len(flips) and len({r["root"] for r in parts}) == 1  # any two differ in at most four bits


def test_personal_data_matches_the_plain_patterns(docs, documents):
    def plain(t):
        luhn = lambda x: sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(x))) % 10 == 0
        digits = lambda m: re.sub("[^0-9]", "", m[0])
        found = [("email", m) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
        found += [("ip", m) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t) if max(map(int, m[0].split("."))) <= 255]
        found += [("card", m) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t) if 16 <= len(digits(m)) <= 19 and luhn(digits(m))]
        found += [("phone", m) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t) if 8 <= len(digits(m)) <= 15]
        return ",".join(f"{k}:{m.start()}:{m.end()}" for k, m in found)

    odd = documents.sparkSession.createDataFrame([(i, t) for i, t in enumerate([
        "a@b.c_x@d.ee a@b.c@d.e 1.2.3.4.5.6.7.8 12.300.1.1 001.2.3.0004", "4111-1111-1111-1112, 41111111111111111 5555555555554444 4111111111111111",
        "é+49 30 1234567- +4 5 +" + "9" * 30, "a" * 100000 + "1" * 100000 + "@" + "b.c" * 20000])], "doc_id long, text string")
    base = [k.name for k in pii.KINDS if k.base]
    for df in (docs, odd, documents):
        rows = df.select("doc_id", "text").collect()
        got = pii.find_personal_data(df).select("doc_id", pii.joined(base)).collect()
        assert _sorted(map(tuple, got)) == _sorted((r["doc_id"], plain(r["text"] or "")) for r in rows)
    more = documents.sparkSession.createDataFrame([(1, "IBAN GB82 WEST 1234 5698 7654 32 and GB82 WEST 1234 5698 7654 33")], "doc_id long, text string")
    assert [len(r["iban"]) for r in pii.find_personal_data(more).collect()] == [1]


def test_ibans_before_capitals(spark):
    codes = ["AT61 1904 3002 3457 3201", "ES91 2100 0418 4502 0005 1332", "BE68539007547034", "GB82 WEST 1234 5698 7654 32", "NO93 8601 1117 947"]
    texts = [f"IBAN {c}{after}" for c in codes for after in (" Please", " BIC CAIXESBB", " THEN", " 1234", " A", ", and", "")]
    texts += [f"IBAN {c[:-1]}{(int(c[-1]) + 1) % 10} Please" for c in codes] + [f"IBAN {codes[0]}X"]
    rows = pii.find_personal_data(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")).collect()
    got = {r["doc_id"]: [texts[r["doc_id"]][x["start"]:x["end"]] for x in r["iban"]] for r in rows}
    assert got == {i: [codes[i // 7]] if i < 35 else [] for i in range(len(texts))}


def test_packing_round_trip(docs, documents):
    from tokenizers import Tokenizer
    whole = Tokenizer.from_file(packing.tokenizer_path())
    odd = documents.sparkSession.createDataFrame([(i, t) for i, t in enumerate([
        "It's İstanbul ſ ΣΑΣ ½ x² ª 中文 é  a b <|endoftext|>", "don't we'll\tnow!! 123 _a_b_ naïve ÀÉ"])], "doc_id long, text string")
    for df in (docs, odd, documents):
        rows = packing.pack_documents(df).collect()
        texts = [(r["doc_id"], r["text"] or "") for r in df.select("doc_id", "text").collect()]
        whole.encode_special_tokens = True
        want = defaultdict(list)
        for (i, _), e in zip(texts, whole.encode_batch([t for _, t in texts], add_special_tokens=False)):
            want[i].append([*e.ids, packing.END])
        got, ends = defaultdict(list), defaultdict(int)
        for r in sorted(rows, key=lambda r: (r["sequence_id"], r["offset"])):
            assert r["offset"] == ends[r["sequence_id"]]
            ends[r["sequence_id"]] += r["length"]
            got[r["doc_id"]].append((r["start"], np.frombuffer(r["ids"], "<u4").tolist()))
        assert max(ends.values()) <= 4096
        for i, lists in want.items():
            assert sorted(x for x in got[i]) == sorted((s, x[s:s + 4096]) for x in lists for s in range(0, len(x), 4096))
    assert packing.pack_documents(docs.limit(0)).count() == 0


def test_tiny_pieces_leave_little_padding(spark):
    tiny = spark.createDataFrame([(i, None if i % 2 else "a") for i in range(4096)], "doc_id long, text string")
    rows = packing.pack_documents(tiny).collect()
    total = sum(r["length"] for r in rows)
    assert len({r["sequence_id"] for r in rows}) == -(-total // 4096)


def test_plan_takes_every_piece_once():
    rng = np.random.default_rng(3)
    histogram = {int(b): int(n) for b, n in zip(rng.choice(np.arange(1, 257), 90, replace=False), rng.integers(1, 4000, 90))}
    plan = packing.plan_packing(histogram, 256)
    taken = defaultdict(int)
    for b, lo, hi, *_ in plan.rows:
        assert lo == taken[b] and hi > lo
        taken[b] = hi
    assert dict(taken) == histogram
    least = max(sum(b * n for b, n in histogram.items()) / 256, sum(n for b, n in histogram.items() if b > 128))
    assert least <= plan.sequences <= 1.1 * least  # no packing of these lengths needs fewer than ``least``


def test_archives_round_trip(spark):
    pages = [(1, "http://a/x y", "<p>é</p>"), (2, None, "<p>é</p>"), (3, "u", None), (4, "u", ""), (None, "n", "<p>é</p>"),
             (5, "u", "long " * 50000), (5, "u", "long " * 50000)]
    df = spark.createDataFrame([(*p, None) for p in pages], "page_id long, url string, html string, part int").repartition(3)
    got = warc.read_archives(spark, warc.archive_pages(df), with_payload=True).collect()
    want = [(i, len((h or "").encode()), warc.payload_digest((h or "").encode()), *(("response", None) if k in (None, i) else ("revisit", k)))
            for (i, _, h), k in zip(pages, (2, 2, 4, 4, 2, 5, 5))]
    assert _sorted((r["page_id"], r["payload_bytes"], r["payload_digest"], r["record_type"], r["refers_to"]) for r in got) == _sorted(want)
    assert {bytes(r["payload"]) for r in got if r["payload"] is not None} == {(h or "").encode() for _, _, h in pages}
    assert warc.read_archives(spark, warc.archive_pages(df.limit(0))).count() == 0


def test_decontamination(spark, docs, documents):
    bench = read(spark, SF001, "benchmark")
    items = {r["item_id"]: " ".join(r["text"].split()) for r in bench.collect()}
    want = {(r["doc_id"], i) for r in documents.collect() for i, t in items.items() if t in " ".join((r["text"] or "").split())}
    assert {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(documents, bench).collect()} == want
    one = spark.createDataFrame([(1, "If John buys 3 apples for 5 dollars each then how many dollars does John pay in total to the shop today"),
                                 (2, None), (3, ""), (None, "a b c d e f g h i j")], "item_id long, text string")
    asked = spark.createDataFrame([
        (1, "Well. If Mary buys 7 apples for 9 dollars each then how many dollars does Mary pay in total to the shop today"),
        (2, "Well. If Mary buys 7 apples for 9 dollars each then how many dollars does Peter pay in total to the shop today"),
        (3, "nothing of it"), (4, None), (None, "If John buys 3 apples")], "doc_id long, text string")
    assert [(r["doc_id"], r["reparameterised"]) for r in decontam.contaminated(asked, one).collect()] == [(1, True)]
    assert decontam.drop_contaminated(asked, one).count() == 4
    assert decontam.contaminated(docs, bench.limit(0)).count() == 0 and decontam.contaminated(docs.limit(0), bench).count() == 0


def _leaks(spark, items, texts):
    """{(doc, item)} of texts and items numbered from 0."""
    frame = lambda name, rows: spark.createDataFrame(list(enumerate(rows)), f"{name} long, text string")
    return {(r["doc_id"], r["item_id"]) for r in decontam.contaminated(frame("doc_id", texts), frame("item_id", items)).collect()}


def test_decontamination_in_any_case(spark):
    plain = "the old mill by the river grinds four sacks of corn before noon and rests until the evening bell"
    caps = "WHICH OF THE TWO LAKES IS DEEPER THAN THE SEA NEAR IT AND WHY IS ITS WATER SO COLD"
    names = "Anna Berg 1850 Carl Dahl 1862 Eva Falk 1871 Gustav Holm 1880 Ida Juhl 1893 Karl Lund"
    texts = [f"Here. {plain.upper()}. More", f"so {plain.title()} it goes", f"well, {caps.lower()}?", f"seen {caps}", f"list, {names}.",
             "WHICH OF THE TWO HILLS IS HIGHER THAN THE TREE NEAR IT AND WHY IS ITS STONE SO GREY", "nothing of it"]
    assert _leaks(spark, [plain, caps, names], texts) == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2)}


def test_decontamination_of_short_items(spark):
    words = "Which rivers of Norway flow into the lake east of Oslo every spring".split()
    items = [" ".join([f"Which{n}", *words[1:n]]) for n in range(3, 14)] + ["Paris", "Who won 1998", "...", ""]
    texts = [x for i in items[:11] for x in (f"Q1) {i}?", f"he asked, {i} and so on", f"Heading {i}")]
    texts += ["it was (paris)", "who won 1998?", "who won 1999?", "-- ...", "which3 rivers in"]
    got = _leaks(spark, items, texts)  # an item can also stand in a longer one's copy, with another name
    assert got >= {(3 * n + k, n) for n in range(11) for k in range(3)} and {x for x in got if x[0] > 32} == {(33, 11), (34, 12)}
    assert _leaks(spark, ["Which box of 3 red ones weighs 5 grams"], ["Q1) Which box of 4 red ones weighs 9 grams"]) == {(0, 0)}


def test_decontamination_of_names_at_the_start_of_a_sentence(spark):
    items = ["Alice has 12 apples and gives 5 to Bob. How many remain?",
             "Tom has 5 red apples. Ann has 7 more. Tom gives 2 away. Ann eats 1. How many are left now?"]
    texts = ["Carol has 30 apples and gives 7 to Dan. How many remain?", "So: Carol has 30 apples and gives 7 to Dan. How many remain?",
             "Kim has 5 red apples. Lea has 7 more. Kim gives 2 away. Lea eats 1. How many are left now?",
             "Carol has 30 apples and gives 30 to Dan. How many remain?"]
    assert _leaks(spark, items, texts) == {(0, 0), (1, 0), (2, 1)}


def test_decontamination_outlives_a_slip(spark):
    asked = ("if {} buys {} apples for {} dollars each then how many dollars does {} pay in total to the shop "
             "when {} brings back {} apples that {} did not like and the shop gives {} the money for them")
    long = " ".join(f"in the year {1900 + n % 7} the ship of captain Berg took {n} sacks of w{n} to port p{n}" for n in range(12))
    texts = [long.replace("Berg took 5 ", "Borg took 5 "), asked.format("Mary", 7, 9, "Mary", "Mary", 4, "Marie", "Mary"),
             asked.format("Mary", 7, 9, "Peter", "Otto", 4, "Hans", "Karl")]
    assert _leaks(spark, [long, asked.format("John", 3, 5, "John", "John", 2, "John", "John")], texts) == {(0, 0), (1, 1)}


@pytest.mark.parametrize("scorer,label", [(quality.score_quality, "quality"), (toxicity.score_toxicity, "toxic")])
def test_classifiers_on_held_out_labels(spark, docs, scorer, label):
    sf = "/root/testdata/sf0.1"  # about 4,000 labels; at sf0.01 some 20 toxic rows are too few to learn from
    labels = read(spark, sf, "labels")
    got = {r["doc_id"]: r for r in scorer(read(spark, sf, "documents"), labels).collect()}
    held = [(got[r["doc_id"]]["predicted"], r[label]) for r in labels.collect() if got[r["doc_id"]]["held_out"]]
    assert held and np.mean([p == y for p, y in held]) >= 0.95
    none = scorer(docs, labels.limit(0)).collect()
    assert len(none) == len(DOCS) and all(r["score"] == 0.5 for r in none)
    assert scorer(docs.limit(0), labels).count() == 0


def test_repeated_rows_of_a_document_train_once(spark, documents):
    labels = read(spark, SF001, "labels")
    twice = quality.train_quality(documents.union(documents), labels.union(labels))
    once = quality.train_quality(documents, labels)
    assert np.array_equal(once.weights, twice.weights) and (once.slope, once.shift) == (twice.slope, twice.shift)


def test_dual_coordinate_descent_separates():
    rng = np.random.default_rng(4)
    y = rng.integers(0, 2, 400)
    rows = [np.unique(np.r_[rng.integers(10, 500, 20), [1] if v else [2]]).astype(np.uint32) for v in y]
    model = linear.fit(rows, y, 512, linear.dual_coordinate_descent)
    assert np.mean((model.probability(model.margins(rows)) > 0.5) == y) > 0.97


def _top(rows, k, scale=64):
    """(query id, rank, id, score) by exact integers; every row is told apart by its place."""
    width = max((len(x) for _, x in rows), default=0)
    v = [[int(np.floor(scale * float(np.float32(c)))) for c in x] + [0] * (width - len(x)) for _, x in rows]
    out = []
    for a, (q, _) in enumerate(rows):
        if q % 20 == 0:
            best = sorted((-sum(x * y for x, y in zip(v[a], v[b])), rows[b][0]) for b in range(len(rows)) if b != a)[:k]
            out += [(q, n + 1, c, -s) for n, (s, c) in enumerate(best)]
    return sorted(out)


def test_top_k_matches_brute_force(spark):
    rng = np.random.default_rng(5)
    data = [(i, [float(x) for x in rng.normal(size=6).round(1)]) for i in range(120)]
    data += [(200 + i, data[0][1]) for i in range(40)] + [(360, [])]
    data += [(20, data[3][1]), (20, data[20][1]), (20, data[20][1]), (21, data[3][1])]  # query ids that several rows hold
    bad = [(300, None), (320, [None, 1.0]), (340, [float("nan")] * 6), (None, data[0][1])]
    df = spark.createDataFrame([(*d, None, None, None) for d in data + bad], "vec_id long, embedding array<float>, label int, v string, nr int")
    assert sorted(map(tuple, topk.top_k(df, k=7).collect())) == _top(data, 7)
    assert topk.top_k(df.limit(0)).count() == 0


def test_top_k_of_rows_that_share_an_id(spark):
    rows = [(20, [1.0, 0.0]), (20, [0.0, 1.0]), (21, [1.0, 1.0])]
    got = sorted(map(tuple, topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>")).collect()))
    assert got == _top(rows, 20) and len(got) == 4


def test_top_k_of_large_components(spark):
    rng = np.random.default_rng(9)
    for size in (1e4, 1e6, 1e7):  # scores below and above 2 ** 53
        rows = [(i, [float(np.float32(c)) for c in rng.normal(size=4) * size]) for i in range(60)]
        got = topk.top_k(spark.createDataFrame(rows, "vec_id long, embedding array<float>"), k=5).collect()
        assert sorted(map(tuple, got)) == _top(rows, 5)
    with pytest.raises(Exception, match="64 bits"):
        topk.top_k(spark.createDataFrame([(20, [1e30]), (1, [1e30])], "vec_id long, embedding array<float>")).collect()


def _hinge(rows, y, buckets, epochs=2000):
    """Weights and bias of the hinge-loss model of scaled indicators, restated on dense rows with cyclic updates."""
    x = np.zeros((len(rows), buckets))
    for i, r in enumerate(rows):
        x[i, r] = 1
    p, q = (1 + x[y == 1].sum(0)), (1 + x[y == 0].sum(0))
    scaled = np.c_[x * np.log((p / p.sum()) / (q / q.sum())), np.ones(len(rows))]
    sign, dual, w = np.where(y == 1, 1.0, -1.0), np.zeros(len(rows)), np.zeros(buckets + 1)
    for _ in range(epochs):
        for i in range(len(rows)):
            new = min(1.0, max(0.0, dual[i] - (sign[i] * (scaled[i] @ w) - 1) / (scaled[i] @ scaled[i])))
            w += (new - dual[i]) * sign[i] * scaled[i]
            dual[i] = new
    return scaled @ w


def test_classifier_matches_a_plain_restatement():
    rng = np.random.default_rng(10)
    y = rng.integers(0, 2, 60)
    rows = [np.unique(rng.integers(0, 40, 6) + 10 * v).astype(np.uint32) for v in y]
    ratios = linear.log_count_ratios(rows, y, 64)
    w, bias = linear.dual_coordinate_descent(rows, y, ratios, epochs=4000)
    margins = np.array([w[r].sum() + bias for r in rows])
    assert np.allclose(margins, _hinge(rows, y, 64), atol=0.02)


def test_character_ngrams_are_those_of_code_points():
    for text in ("", "a", "\u00c9t\u00e9 \u4e2d\u6587 \U0001f600!", "ab" * 50):
        padded = f" {text.lower()} "
        want = {padded[i:i + n] for n in toxicity.SIZES for i in range(len(padded) - n + 1)}
        assert len(toxicity.char_ngrams(text)) == len(want)  # so few n-grams don't share a bucket
    grams, block = toxicity.char_ngrams("\u00e9\u4e2d" * 500 + "xyz"), toxicity.BLOCK
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(toxicity, "BLOCK", 64)
        assert np.array_equal(toxicity.char_ngrams("\u00e9\u4e2d" * 500 + "xyz"), grams) and toxicity.BLOCK != block


def test_training_sample_is_bounded_by_ids(spark, documents):
    labels = read(spark, SF001, "labels")
    seen = []

    def solver(rows, y, ratios):
        seen.append((len(rows), sum(map(len, rows))))
        return np.zeros(len(ratios)), 0.0

    linear.train(documents, labels, "quality", quality.word_ngrams, 1 << 20, solver, 5000, 3000)
    assert max(n for _, n in seen) <= 6000 and max(r for r, _ in seen) >= 2


@pytest.mark.parametrize("train", [quality.train_quality, toxicity.train_toxicity])
def test_fitted_models_score_awkward_rows(spark, docs, train):
    """Null, empty, very long and repeated texts beside clashing columns: a score each, equal texts alike."""
    name = "quality" if train is quality.train_quality else "toxic"
    labels = spark.createDataFrame([(i, i % 2) for i in (1, 2, 3, 4, 5, 6, 7, 8, 9)] + [(None, 1), (5, None), (999, 0)], f"doc_id long, {name} int")
    model = train(docs, labels)
    features = quality.word_ngrams if name == "quality" else toxicity.char_ngrams
    got = linear.score(docs, model, features, ["doc_id", "text", "score", "_text"]).collect()
    assert len(got) == len(DOCS) and all(0 <= r["score"] <= 1 for r in got)
    by_text = defaultdict(set)
    for r in got:
        by_text[r["text"] or ""].add(r["score"])
    assert all(len(v) == 1 for v in by_text.values())


def test_pipeline_matches_brute_force(spark, documents):
    scored = linear.score(documents, quality.train_quality(documents, read(spark, SF001, "labels").where(linear.fold("doc_id", 5) != 0)),
                          quality.word_ngrams, ["doc_id"]).collect()
    good = {r["doc_id"] for r in scored if r["score"] >= 0.3}
    rows = [(r["doc_id"], r["text"]) for r in documents.collect() if r["doc_id"] in good]
    rows = [(i, t) for i, _, _, t in _line_dedup(rows)]
    keep = {i for i, _, low in _components(rows) if i == low}
    items = [" ".join(r["text"].split()) for r in read(spark, SF001, "benchmark").collect()]
    rows = [(i, t) for i, t in rows if i in keep and not any(b in " ".join(t.split()) for b in items)]
    table = packing.token_ids(packing.tokenizer_path())
    want = {i: len(table.ids(t)) // 4 + 1 for i, t in rows}
    got = corpus_pipeline.run(spark, SF001).collect()
    assert {r["doc_id"]: r["doc_tokens"] for r in got} == want
    assert sum(r["length"] for r in got) == sum(want.values())


def test_every_query_is_registered():
    import __spark_entry__ as entry
    assert {*queries.QUERIES, "pipeline"} <= set(entry.queries()) and len(queries.QUERIES) == 13


def test_stages_keep_awkward_rows_and_clashing_columns(spark, documents):
    """Every stage but the last returns its input's columns, whatever their names, with the values of the rows it keeps."""
    names = ["quality_score", "_quality_score", "_text", "n_lines", "n_dropped", "_id", "h1", "kept", "fp", "component_id", "item_id", "part"]
    odd = spark.createDataFrame([(None, None, None, None, None), (900001, None, "en", None, 0), (900002, "", "en", "s", 0),
                                 (900003, "word " * 30000, "en", "s", 0)], documents.schema)
    both = documents.limit(40).union(odd).union(odd.limit(2))
    wide = both.select("*", *[F.lit(n).alias(n) for n in names])
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, wide, SF001)
        assert out.columns == wide.columns, name
        rows = out.collect()
        assert rows and all(r[n] == n for r in rows for n in names), name
        if name != "quality":
            assert any(r["text"] is None for r in rows), name
        assert stage(spark, wide.limit(0), SF001).count() == 0
    packed = corpus_pipeline.packing_stage(spark, wide, SF001)
    assert packed.count() >= wide.count()
