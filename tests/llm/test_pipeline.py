"""The corpus pipeline: what each stage keeps, against plain code."""

import hashlib
import random

import public_tokenizers
import pytest
import sentencepiece as library

import corpus_pipeline
from tidegate.llm import minhash

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"
draw = random.Random(9)
VOCABULARY = ["".join(draw.choice("abcdefghijklmno") for _ in range(6)) for _ in range(3000)]
PASSAGE = " ".join(VOCABULARY[:60])


def prose(words):
    return " ".join(draw.choice(VOCABULARY) for _ in range(words))


@pytest.fixture(scope="module")
def corpus(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("corpus"))
    clean = [prose(80) for _ in range(60)]
    # Said three times: a plain cosine does not find a word that stands once among fifty.
    toxic = [f"{prose(40)} you {w}, {w}, {w} {prose(10)}" for w in draw.choices(["grobian", "schuft"], k=40)]
    shared = [f"{prose(20)}\n{PASSAGE}\n{prose(20)}" for _ in range(5)]
    words = clean[0].split()
    near = [" ".join(words[:k] + ["changed"] + words[k + 1 :]) for k in (0, 79)]
    texts = clean + toxic + shared + near + [clean[1], None, ""]
    rows = [(i, t, "en", f"s{i % 4}" if i % 5 else None, len(t or "")) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, COLUMNS).write.parquet(f"{folder}/documents.parquet")
    labels = [(i, 1, int(60 <= i < 100)) for i in range(100)]
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return folder, texts


def test_every_stage_takes_effect(spark, corpus):
    folder, texts = corpus
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "line_dedup", "near_dedup", "mixing", "sentencepiece"]
    docs, held = spark.read.parquet(f"{folder}/documents.parquet"), {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, folder)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        held[name] = docs.collect()

    gone = set(range(len(texts))) - {r["doc_id"] for r in held["toxicity"]}
    assert gone <= set(range(60, 100)) and len(gone) >= 36

    lines = {r["doc_id"]: r["text"] for r in held["line_dedup"]}
    assert [i for i, t in lines.items() if PASSAGE in (t or "")] == [100]
    assert 107 not in lines
    assert all(lines[i] == texts[i] for i in lines if not 100 < i < 105)
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in held["line_dedup"])

    sets = {i: minhash.shingles(minhash.words_of(t), 5) for i, t in lines.items()}
    linked = {
        i for i in sets for j in sets if j < i and sets[i] and 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])
    }
    assert {105, 106} <= linked
    assert {r["doc_id"] for r in held["near_dedup"]} == set(lines) - linked

    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in held["near_dedup"]}
    taken = {}
    for r in held["mixing"]:
        taken[r["doc_id"]] = taken.get(r["doc_id"], 0) + len(r["text"].split())
    assert all(taken[i] <= 3 * sizes[i] for i in taken)
    assert sum(sizes.values()) - 5 <= sum(taken.values()) <= sum(sizes.values())

    processor = library.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))

    def expected(row):
        ids = processor.encode(row["text"])
        return row["doc_id"], len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()

    found = sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in held["sentencepiece"])
    assert found == sorted(map(expected, held["mixing"]))
    assert sorted((r["doc_id"], r["n_tokens"], r["ids_sha256"]) for r in corpus_pipeline.run(spark, folder).collect()) == found


EDGE_COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, score string, row int, `cuts` string, kept string"


def edge_folder(spark, folder, rows, labels=()):
    full = [(i, t, "en", source, len(t or ""), "s", 1, "c", "k") for i, t, source in rows]
    spark.createDataFrame(full, EDGE_COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return spark.read.parquet(f"{folder}/documents.parquet")


def stages(spark, docs, folder):
    """What each stage returns, given what the one before returned."""
    held = {}
    for name, function in corpus_pipeline.STAGES:
        out = function(spark, docs, folder)
        if name != "sentencepiece":
            assert out.columns == docs.columns
        out.write.parquet(f"{folder}/{name}")
        docs = spark.read.schema(out.schema).parquet(f"{folder}/{name}")
        held[name] = docs.collect()
    return held


def test_edge_rows_pass_every_stage(spark, tmp_path):
    """NULL, empty and repeated rows, NULL ids, clashing columns; without labels nothing is toxic."""
    folder = str(tmp_path)
    rows = [(1, None, "a"), (2, "", "a"), (None, "a b c", "a"), (None, "a b c", None), (3, prose(60), None), (3, "other words here", None)]
    rows += [(4, "same text", "b"), (4, "same text", "b"), (5, " \n ", "b")]
    held = stages(spark, edge_folder(spark, folder, rows), folder)
    ids = lambda name: sorted((r["doc_id"] for r in held[name]), key=repr)
    assert ids("toxicity") == sorted((i for i, _, _ in rows), key=repr)
    assert ids("line_dedup") == ids("toxicity")
    # Of the rows of one id one stays; those without an id all stay.
    assert ids("near_dedup") == sorted([1, 2, 3, 4, 5, None, None], key=repr)
    sizes = {r["doc_id"]: len((r["text"] or "").split()) for r in held["near_dedup"]}
    assert {r["doc_id"] for r in held["mixing"]} <= set(sizes)
    assert len(held["sentencepiece"]) == len(held["mixing"])
    assert {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(held["sentencepiece"][0].asDict())


def test_no_rows_pass_every_stage(spark, tmp_path):
    folder = str(tmp_path)
    held = stages(spark, edge_folder(spark, folder, []), folder)
    assert all(found == [] for found in held.values())


def test_an_id_with_one_toxic_text_goes(spark, tmp_path):
    folder = str(tmp_path)
    clean = [(i, prose(40), "a") for i in range(60)]
    toxic = [(100 + i, f"{prose(10)} grobian grobian grobian {prose(5)}", "a") for i in range(40)]
    both = [(200, prose(40), "a"), (200, f"{prose(10)} grobian grobian grobian {prose(5)}", "a")]
    labels = [(i, 1, int(i >= 100)) for i, _, _ in clean + toxic]
    docs = edge_folder(spark, folder, clean + toxic + both, labels)
    kept = {r["doc_id"] for r in corpus_pipeline.reject_toxic(spark, docs, folder).collect()}
    assert 200 not in kept
    assert len(kept & set(range(60))) >= 57
    assert len(kept & set(range(100, 140))) <= 4
