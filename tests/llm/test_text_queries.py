"""The registered text queries against their SQL, or against plain code where SQL can't express them."""

import hashlib
import os
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece as library
from conftest import SF_DIR
from oracle import compare, connect

import __spark_entry__ as contract
from tidegate.llm import pii
from tidegate.llm.queries import QUERIES, SQL


@pytest.fixture(scope="module")
def db():
    return connect(SF_DIR)


def test_all_are_registered():
    names = set(contract.queries())
    assert {n.split("_")[0] for n in QUERIES if n != "pipeline"} == {f"op{n}" for n in range(1, 14)}
    assert set(QUERIES) <= names
    assert "pipeline" in names


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_its_sql(spark, db, name):
    equal, message = compare(QUERIES[name](spark, SF_DIR), db, SQL[name])
    assert equal, message


def documents(db):
    return db.execute("SELECT doc_id, coalesce(text, '') FROM documents ORDER BY doc_id").fetchall()


def test_sentencepiece_equals_the_library(spark, db):
    processor = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    found = {r["doc_id"]: r for r in QUERIES["op4_sentencepiece"](spark, SF_DIR).collect()}
    for doc_id, text in documents(db):
        ids = processor.encode(text)
        row = found.pop(doc_id)
        assert row["n_tokens"] == len(ids)
        assert row["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert row["decoded_sha256"] == hashlib.sha256(processor.decode(ids).encode()).hexdigest()
        pieces = processor.encode(text, return_type="proto").pieces
        spans = np.array([(p.id, p.begin, p.end) for p in pieces], "<i4")
        assert row["spans_sha256"] == hashlib.sha256(spans.tobytes()).hexdigest()
        assert row["n_bytes"] == len(text.encode())
    assert not found


def plain_pii(text):
    """The base spans by the patterns as they are stated."""
    found = [(m.start(), 0, m.end()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            found.append((m.start(), 1, m.end()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        digits = [int(c) for c in m[0] if c.isdigit()]
        total = sum(d if k % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d) for k, d in enumerate(reversed(digits)))
        if 12 <= len(digits) <= 19 and total % 10 == 0:
            found.append((m.start(), 2, m.end()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 9 <= sum(c.isdigit() for c in m[0]) <= 15:
            found.append((m.start(), 3, m.end()))
    return sorted(found)


def test_pii_base_spans_equal_the_patterns(spark, db):
    found = {r["doc_id"]: r for r in QUERIES["op3_pii"](spark, SF_DIR).collect()}
    for doc_id, text in documents(db):
        row, base = found.pop(doc_id), plain_pii(text)
        joined = ",".join(f"{pii.KINDS[k]}:{a}:{b}" for a, k, b in base)
        assert row["base_sha256"] == hashlib.sha256(joined.encode()).hexdigest()
        assert [row[f"n_{kind}"] for kind in pii.KINDS] == [sum(k == i for _, k, _ in base) for i in range(4)]
        assert set(filter(None, joined.split(","))) <= set(row["spans"].split(","))
    assert not found


def test_toxicity_on_held_out_rows(spark, db):
    found = {r["doc_id"]: r for r in QUERIES["op8_toxicity"](spark, SF_DIR).collect()}
    labels = dict(db.execute("SELECT doc_id, toxic FROM labels").fetchall())
    assert len(found) == db.execute("SELECT count(*) FROM documents").fetchall()[0][0]
    right = total = 0
    for doc_id, row in found.items():
        assert row["held_out"] == (zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= row["score"] <= 1
        assert row["predicted"] == int(row["score"] >= 0.5)
        if row["held_out"] and doc_id in labels:
            total += 1
            right += row["predicted"] == labels[doc_id]
    assert right >= 0.9 * total


def held_out_counts(rows, labels):
    """Right and all toxic rows, and all rows predicted toxic, among labelled held-out ones."""
    pairs = [(labels[r["doc_id"]], r["predicted"]) for r in rows if r["held_out"] and r["doc_id"] in labels]
    return sum(y and p for y, p in pairs), sum(y for y, _ in pairs), sum(p for _, p in pairs)


def test_toxicity_recall_and_precision(spark):
    folder = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.1")
    labels = {r["doc_id"]: r["toxic"] for r in spark.read.parquet(f"{folder}/labels.parquet").collect()}
    rows = QUERIES["op8_toxicity"](spark, folder).collect()
    right, toxic, predicted = held_out_counts(rows, labels)
    assert toxic >= 90
    assert right >= 0.9 * toxic
    assert right >= 0.85 * predicted
    # Every text with a word of four letters has neighbours, and clean ones are among them.
    texts = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{folder}/documents.parquet").collect()}
    assert all(r["evidence"] for r in rows if re.search(r"[^\W\d_]{4}", texts[r["doc_id"]]))
    assert sum(bool(r["evidence"]) for r in rows) >= 0.999 * len(rows)
    assert sum(":0:" in r["evidence"] for r in rows) > len(rows) / 2


def test_neighbours_recall(spark, db):
    rows = db.execute("SELECT vec_id, embedding FROM embeddings").fetchall()
    ids = np.array([r[0] for r in rows])
    vectors = np.array([r[1] for r in rows], float)
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    found = {}
    for r in QUERIES["op10_neighbours"](spark, SF_DIR).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    hits = total = 0
    for own in ids[ids % 50 == 0]:
        q = int(np.flatnonzero(ids == own)[0])
        scores = (vectors * vectors[q]).sum(axis=1) / (norms * norms[q])
        order = sorted((-s, i) for s, i in zip(scores, ids, strict=True) if i != own)[:5]
        answer = sorted(found.pop(int(own)))
        assert [rank for rank, _, _ in answer] == [1, 2, 3, 4, 5]
        for _, vec_id, score in answer:
            assert score == pytest.approx(float(scores[int(np.flatnonzero(ids == vec_id)[0])]), abs=1e-12)
        hits += len({i for _, i in order} & {i for _, i, _ in answer})
        total += 5
    assert not found
    assert hits >= 0.95 * total
