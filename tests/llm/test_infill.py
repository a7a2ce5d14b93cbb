"""Fill-in-middle against plain code, and the exact round trip."""

import hashlib
import random
import re

import pytest

from tidegate.llm import infill

SCHEMA = "doc_id long, text string, row int, k string, n string"


def frame(spark, rows):
    return spark.createDataFrame([(*r, 3, "x", "y") for r in rows], SCHEMA)


def plain(doc_id, text):
    text = text or ""
    units = re.findall(r"[A-Za-z]+|[^A-Za-z]", text)
    digest = hashlib.sha256(f"1:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[k : k + 8], 16) for k in (0, 8, 16, 24))
    first, second = sorted((h1 % (len(units) + 1), h2 % (len(units) + 1)))
    p, m, s = ("".join(u) for u in (units[:first], units[first:second], units[second:]))
    if not text or any(x in text for x in ("<P>", "<S>", "<M>")) or h3 % 100 >= 90:
        form, output, chars = "plain", text, (None, None)
    elif h4 % 100 < 20:
        form, output, chars = "spm", f"<S>{s}<P>{p}<M>{m}", (len(p), len(m))
    else:
        form, output, chars = "psm", f"<P>{p}<S>{s}<M>{m}", (len(p), len(m))
    sha = [hashlib.sha256(t.encode()).hexdigest() for t in (output, text)]
    return (doc_id, len(units), form, *chars, *sha), output


def random_texts(n):
    draw = random.Random(8)
    pool = ["a", "Zy", "é", " ", "\n", "<", "P>", "S", "M>", "1", "梦", "😀", "<M"]
    return [(i, "".join(draw.choice(pool) for _ in range(draw.randint(0, 40)))) for i in range(n)]


EDGES = [(1, None), (2, ""), (None, "ab cd"), (None, "ab cd"), (3, "same"), (3, "same"), (3, "other"), (4, "a<S>b"), (5, "<S"), (-6, "<P")]


def test_rows_equal_plain_code(spark):
    rows = EDGES + random_texts(400)
    found = sorted((tuple(r) for r in infill.digests(frame(spark, rows)).collect()), key=repr)
    assert found == sorted((plain(*r)[0] for r in rows), key=repr)
    assert {r[2] for r in found} == {"plain", "psm", "spm"}


def test_outputs_equal_plain_code(spark):
    rows = EDGES + random_texts(100)
    found = sorted((tuple(r) for r in infill.transform(frame(spark, rows)).collect()), key=repr)
    assert found == sorted(((k, plain(k, t)[0][2], plain(k, t)[1]) for k, t in rows), key=repr)


def test_no_rows(spark):
    assert infill.digests(frame(spark, [])).collect() == []


@pytest.mark.parametrize("size", [1, 3, 5])
def test_small_pieces_and_stretches_change_nothing(monkeypatch, size):
    monkeypatch.setattr(infill, "UNITS", size)
    monkeypatch.setattr(infill, "STRETCH", size)
    for key, text in random_texts(200):
        expected, output = plain(key, text)
        digest = hashlib.sha256(f"1:{key}".encode()).hexdigest()
        made = list(infill.pieces(0, key, text, digest))
        assert [k for k, _ in made] == sorted(k for k, _ in made)
        assert b"".join(v for _, v in made[1:]).decode() == output
        again = sorted(infill._assembled(iter(made)), key=lambda kv: kv[0])
        assert list(infill._restored(iter(again))) == [expected]


def test_a_long_text_is_many_pieces(spark):
    text = "word, " * 200_000 + "q" * 1_500_000
    (row,) = infill.digests(frame(spark, [(7, text)])).collect()
    assert tuple(row) == plain(7, text)[0]
    counts = infill.sorted_pieces(frame(spark, [(7, text)])).map(lambda kv: len(kv[1])).collect()
    assert len(counts) > 70


def test_the_second_sort_moves_nothing(spark):
    first = infill.sorted_pieces(frame(spark, random_texts(20)))
    keyed = first.mapPartitions(infill._assembled, preservesPartitioning=True)
    again = keyed.repartitionAndSortWithinPartitions(first.getNumPartitions(), infill.by_row)
    assert again.toDebugString().count(b"PairwiseRDD") == 1


def test_an_output_without_its_marks_is_refused():
    splitter = infill.Splitter(infill.PSM)
    assert list(splitter.feed(b"<P>abc"))
    with pytest.raises(ValueError, match="mark"):
        list(splitter.close())
