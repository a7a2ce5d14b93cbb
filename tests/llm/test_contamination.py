"""Benchmark decontamination against plain code."""

import hashlib
import random
import re

import numpy as np
import pytest

from tidegate.llm import contamination

DOCS = "doc_id long, text string, item_id int, n_words string, segment long"
ITEMS = "item_id long, text string, w long, term string"


def frames(spark, docs, items):
    docs = [(*d, 1, "x", 2) for d in docs]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame([(*i, 5, "y") for i in items], ITEMS)


def plain_words(text):
    lowered = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lowered)


def plain_windows(items, width):
    """Items by window."""
    found = {}
    for item, text in items:
        words = plain_words(text)
        if item is not None and words:
            for s in range(max(len(words) - width, 0) + 1):
                found.setdefault(tuple(words[s : s + width]), set()).add(str(item))
    return found


def plain(docs, items, width, slop):
    windows, rows = plain_windows(items, width), []
    for doc, text in docs:
        words, hit, exact, near = plain_words(text), set(), set(), set()
        at = {}
        for p, w in enumerate(words):
            at.setdefault(w, set()).add(p)
        for window, names in windows.items():
            for s in range(-slop - width, len(words) + slop):
                if words[max(s, 0) : s + len(window)] == list(window) and s >= 0:
                    hit.update(range(s, s + len(window)))
                    exact |= names
                if all(any(abs(p - s - o) <= slop for p in at.get(w, ())) for o, w in enumerate(window)):
                    near |= names
        sha = [hashlib.sha256(",".join(sorted(x)).encode()).hexdigest() for x in (exact, near)]
        rows.append((doc, len(words), len(hit), len(exact), sha[0], bool(hit), len(near), sha[1]))
    return sorted(rows, key=repr)


def found(spark, docs, items, **options):
    return sorted((tuple(r) for r in contamination.decontaminate(*frames(spark, docs, items), **options).collect()), key=repr)


def test_random_texts_equal_plain_code(spark):
    draw = random.Random(3)
    prose = lambda n: " ".join(draw.choice(["a", "b", "c", "Dd", "é9", "f"]) for _ in range(n))
    items = [(i, prose(draw.randint(1, 9))) for i in range(30)] + [(7, "z z z"), (11, prose(4))]
    docs = [(i, prose(draw.randint(0, 60))) for i in range(40)]
    docs += [(50 + i, f"{prose(5)} {text.upper()}, {prose(3)}") for i, (_, text) in enumerate(items[:10])]
    for slop in (0, 1, 2):
        assert found(spark, docs, items, width=4, slop=slop) == plain(docs, items, 4, slop)


def test_small_segments_and_blocks_change_nothing(spark, monkeypatch):
    draw = random.Random(4)
    prose = lambda n: " ".join(f"w{draw.randint(0, 12)}" for _ in range(n))
    items = [(i, prose(6)) for i in range(40)]
    docs = [(i, prose(200)) for i in range(10)]
    expected = plain(docs, items, 3, 1)
    numbers = contamination.Segment(0)
    for key, text in docs:
        numbers.add(key, text.encode())
    lists = index_lists(numbers)
    monkeypatch.setattr(contamination, "PLACES", 50)
    monkeypatch.setattr(contamination, "STRETCH", 7)
    again = contamination.Segment(0)
    for key, text in docs:
        again.add(key, text.encode())
    assert [x.tolist() for x in index_lists(again)] == [x.tolist() for x in lists]
    assert found(spark, docs, items, width=3, slop=1) == expected


def index_lists(segment):
    from pyspark.sql import types as T
    from pyspark.sql.pandas.types import to_arrow_schema

    out = to_arrow_schema(T.StructType.fromDDL(contamination._schema("bigint")))
    batches = list(segment.rows(out))
    lists = contamination.Lists(
        [t for b in batches for t in b.column(1).to_pylist()], [p for b in batches for p in b.column(3).to_pylist()]
    )
    return lists.bases, lists.positions, lists.keys, lists.begin, lists.count


def test_edges(spark):
    long = "x " * 300_000 + "one two three " + "y" * 2_000_000
    docs = [(1, None), (2, ""), (None, "one two three"), (3, "one two three"), (3, "one two three"), (4, " ,;\x00"), (5, long)]
    docs += [(6, "One, TWO... three!"), (7, "one two\nthree four"), (8, "one\x7ftwo"), (9, "naïve Ünder 梦")]
    items = [(1, "one two three"), (1, "four"), (None, "one"), (2, None), (3, ""), (10, "one two three"), (9, "NAïVE Ünder 梦")]
    assert found(spark, docs, items) == plain(docs, items, 10, 2)
    rows = {r[0]: r for r in found(spark, docs, items)}
    assert rows[5][1:4] == (300_004, 3, 2)
    assert rows[7][2:4] == (4, 2)
    assert rows[9][2:4] == (3, 1)
    assert found(spark, [], items) == []
    assert [r[1:4] for r in found(spark, [(1, "one two")], [])] == [(2, 0, 0)]
    assert found(spark, [], []) == []


def test_copies_of_items_and_documents(spark):
    text = " ".join(f"v{i}" for i in range(14))
    items = [(i, text) for i in range(300)]
    docs = [(i, f"start {text} end") for i in range(200)]
    rows = found(spark, docs, items)
    assert {r[1:4] for r in rows} == {(16, 14, 300)}
    assert len(rows) == 200


def test_an_index_is_stored_and_searched_again(spark, folder):
    docs, _ = frames(spark, [(1, "a b c d"), (2, "a x b c")], [])
    contamination.build(docs, path=folder)
    index = contamination.stored(spark, folder)
    phrases = spark.createDataFrame([(1, ["b", "c"]), (2, ["a", "b"]), (3, ["a", "q"])], "w long, terms array<string>")
    names = {(r["segment"], r["row"]): r["key"] for r in index.documents.collect()}
    rows = contamination.search(index, phrases, slop=1).where("w IS NOT NULL").collect()
    assert sorted((names[r["segment"], r["row"]], r["w"], r["exact"]) for r in rows) == [
        (1, 1, False),
        (1, 1, True),
        (1, 2, False),
        (1, 2, True),
        (2, 1, False),
        (2, 1, True),
        (2, 2, False),
    ]
    with pytest.raises(ValueError, match="tolerance"):
        contamination.search(index, phrases, slop=200)


def test_numbers_come_back():
    values = np.array([0, 1, 127, 128, 16_383, 16_384, 2**31, 2**40, 5])
    data, begin = contamination.varints(values)
    back, ends = contamination.of_varints(np.frombuffer(data, np.uint8))
    assert back.tolist() == values.tolist()
    assert ends.tolist() == begin[1:].tolist()
    assert contamination.of_varints(np.zeros(0, np.uint8))[0].tolist() == []
