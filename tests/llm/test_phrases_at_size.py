"""What phrase mining sends: hashes and counts packed by cell, phrases that can't be frequent left out."""

import numpy as np
import pyarrow as pa
import pytest

from vaultspark.llm import phrases


def _batch(rows):
    return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"])


def _screen(held, least, cells=phrases.CELLS):
    sent = [b for part in held for b in phrases._send_hashes([part >> np.uint64(64 - phrases.SCREEN_BITS)], least, cells)]
    got = {c: np.frombuffer(w.as_py(), "<u8") for b in phrases._screened(iter(sent), least, cells) for c, w in zip(b["cell"].to_pylist(), b["bits"])}
    each = [got.get(c, np.zeros(1, np.uint64)) for c in range(cells)]
    sizes = np.array([len(x) for x in each])
    return sent, (np.concatenate(each), np.cumsum(sizes) - sizes, (64 * sizes - 1).astype(np.uint64))


def test_the_screen_holds_all_that_is_frequent_and_little_else():
    """Counts of several tasks meet; a hash of the border takes a few bytes and seldom passes."""
    rng = np.random.default_rng(5)
    hashes = rng.integers(0, 1 << 63, 200_000, np.uint64) * np.uint64(2)
    frequent, border = hashes[:1000], hashes[1000:]
    sent, screen = _screen([np.concatenate([frequent, frequent, part]) for part in np.split(border, 4)[:3]] + [frequent], 7)
    assert phrases._passed(screen, frequent).all() and phrases._passed(screen, border).mean() < 0.06
    assert sum(b.nbytes for b in sent) < 8 * (len(border) + 7 * len(frequent))
    _, none = _screen([border[:50]], 7)
    assert not phrases._passed(none, border[:50]).any()


@pytest.mark.parametrize("values", [[], [0], [0, 0, 255, 256], [1 << 63, 3, 1 << 40]])
def test_packed_numbers_are_the_same_again(values):
    values = np.array(values, np.uint64)
    assert phrases._unpacked(phrases._packed(values)).tolist() == values.tolist()


def test_sent_counts_are_the_same_again():
    """Words of several langs, among them an empty and a null-like name, words beyond ASCII, and phrases of all lengths."""
    texts = [("en", "a b c, a b é\x1c a b"), ("", "a b"), ("x y", "b a. " * 3), ("None", "ü " * 5), ("en", ". .")]
    parts = [p for chunk in phrases._chunks(iter([_batch(texts)]), 2) for p in phrases._count(*chunk, 3, 0, None, None, True)]
    added = list(phrases._add_up(iter(parts), 3, 0))
    rows = [r for b in added for r in b.to_pylist()]
    sent = [phrases._send(b, 3, phrases.CELLS) for b in added]
    got = [r for b in phrases._received(iter(sent), 3) for r in b.to_pylist()]
    assert sorted(map(repr, got)) == sorted(map(repr, rows)) and {r["k"] for r in got} == {0, 1, 2, 3}


def test_what_the_screen_leaves_out_is_not_counted():
    hashes = phrases._words(b"a b a b c", "en", [0])[0][0]
    kept = np.concatenate([hashes[:2], phrases._mix(hashes[:1], hashes[1:2])])
    _, screen = _screen([kept], 1)
    rows = [r for p in phrases._count("en", b"a b a b c", b"", 3, 0, None, None, True, screen) for r in p.to_pylist()]
    counted = {(r["k"], r["word"]): r["a"] for r in rows}
    assert counted == {(0, None): 5, (1, "a"): 2, (1, "b"): 2, (2, None): 2}


def test_joins_with_what_was_found_are_never_broadcast(spark):
    """Spark takes rows from compressed files, and more so what explodes, for much smaller than they are."""
    found = spark.createDataFrame([(2, [7, 8], None, None, 20), (3, [7, 8, 9], None, None, 12), (2, [8, 9], None, None, 15), (1, [7], "en", "a", 30),
                                   (1, [8], "en", "b", 40), (1, [9], "en", "c", 50)], "k int, w array<long>, lang string, word string, a long")
    scores, names = phrases.scored(found), found.where("k >= 2").select("w")
    for df in (scores, phrases.standing(found, 3), phrases.with_lang(names, found)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" in plan and "Broadcast" not in plan
    assert {(tuple(r["w"]), r["lang"]) for r in phrases.with_lang(names, found).collect()} == {((7, 8), "en"), ((7, 8, 9), "en"), ((8, 9), "en")}
    assert "SortMergeJoin" in phrases.spelled(names, found)._jdf.queryExecution().executedPlan().toString()
    assert {(tuple(r["w"]), r["phrase"]) for r in phrases.spelled(names, found).collect()} == {((7, 8), "a b"), ((7, 8, 9), "a b c"), ((8, 9), "b c")}
