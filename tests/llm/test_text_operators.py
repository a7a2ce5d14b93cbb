"""Edge cases of the text operators: NULLs, empty and long texts, ties, repeated rows, empty tables, clashing names."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from sentencepiece import SentencePieceNormalizer, SentencePieceProcessor, sentencepiece_model_pb2

from tidegate.llm import components, licenses, lines, merkle, minhash, mixing, neighbours, pii, secrets, sentencepiece, toxicity

SCHEMA = "doc_id long, text string, source string, size long, label int, __row string"


@pytest.fixture
def docs(spark):
    def make(*rows):
        full = [(*r, *(None,) * (3 - len(r)), 1, 1, "x") for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


LONG = "word " * 60_000


def edge(docs):
    return docs((1, None), (2, ""), (3, LONG), (4, "a b"), (4, "a b"), (None, "a b"), (5, " \n\t "))


def rows_of(df, *names):
    return sorted((tuple(r[n] for n in names) for r in df.collect()), key=repr)


MODEL = public_tokenizers.path("piece_bpe_32k.model")
PER_ROW = {
    "licenses": licenses.scan,
    "pii": pii.scan,
    "secrets": secrets.scan,
    "sentencepiece": lambda df: sentencepiece.digests(df, MODEL),
    "minhash": minhash.near_duplicates,
    "mixing": mixing.allot,
    "merkle": merkle.compare_edited,
    "lines": lines.dedup,
    "toxicity": lambda df: toxicity.classify(df, df.select("doc_id", F.lit(0).alias("toxic"))),
}


@pytest.mark.parametrize("name", PER_ROW)
def test_edge_rows_and_empty_tables(docs, name):
    given = edge(docs)
    found = PER_ROW[name](given)
    assert sorted(str(r["doc_id"]) for r in found.collect()) == sorted(str(r["doc_id"]) for r in given.collect())
    assert PER_ROW[name](given.where("false")).collect() == []


# Licenses


@pytest.mark.parametrize(
    ("text", "labels"),
    [
        ("Licensed under the Apache License, Version 2.0", "apache-2.0"),
        ("licensed under Apache license 2.0", "apache-2.0"),
        ("licensed under the apache software license 2.0", ""),
        ("Licensed under CC BY-NC 4.0.", "cc-by,cc-by-nc-4.0"),
        ("Copyright (c) 2020 A. Writer. All rights reserved.", "notice,reserved"),
        ("Copyright all rights reserved", "reserved"),
        ("General Public License general public license", "gpl"),
        ("ALL  RIGHTS\nRESERVED", "reserved"),
        ("all rights", ""),
    ],
)
def test_license_labels(docs, text, labels):
    (row,) = licenses.scan(docs((1, text))).collect()
    assert row["labels"] == labels
    assert (row["score"] > 0) == bool(labels)


def test_license_templates_are_checked():
    with pytest.raises(ValueError, match="endOptional"):
        licenses.parse("a <<endOptional>>")
    with pytest.raises(ValueError, match="beginOptional"):
        licenses.parse("<<beginOptional>> a")
    machine = licenses.Automaton({"t": "a <<var;words=1-2>> b <<beginOptional>>c <<beginOptional>>d<<endOptional>><<endOptional>>"})
    assert [m[1:] for m in machine.matches("a x b c d".split())] == [(0, 3), (0, 4), (0, 5)]
    assert not list(machine.matches("a b".split()))
    assert not list(machine.matches("a x y z b".split()))


# Personal data


def test_field_finds_what_the_patterns_miss(docs):
    texts = [
        f"call +1 ({200 + i}) 555-{1000 + i} or write a{i}.x@mail{i}.org from 10.{i}.3.4 id {i * 7919}" for i in range(100)
    ]
    given = docs(*enumerate(texts), (1000, "call (434) 555-2368 now"))
    field = pii.train(given)
    found = {r["doc_id"]: r["spans"] for r in pii.scan(given, field).collect()}
    assert found[3].startswith("phone:5:22,email:32:46,ip:52:60")
    assert found[3].count(":") == 6
    assert field.find("reach +1 (212) 555-0000 today") == [(6, pii.PHONE, 23)]


def test_long_texts_of_numbers_are_not_the_sample(docs):
    numbers = [(i, "\n".join(f"row {i * 1000 + k} of" for k in range(1_000))) for i in range(40)]
    mails = [(100 + i, f"write to ann{i}@mail{i}.org today") for i in range(12)]
    field = pii.train(docs(*numbers, *mails))
    assert field.weights.any()
    assert field.find("ask bob.x@host.net now") == [(4, pii.EMAIL, 18)]
    assert max(sum(part == k for part, *_ in pii.sample(numbers[0][1])) for k in range(len(pii.SAMPLE))) == pii.QUOTA


def test_base_patterns_take_long_runs(docs):
    text = "a" * 50_000 + "@" + "1" * 50_000 + "." * 1000 + "+" + "1" * 50_000
    assert pii.base_spans(text) == []


# Secrets


def test_ownership_parts_examples_from_live_secrets(docs):
    shared, own = "token = 'abcdefgh1234'", "gho_" + "A1b2" * 10
    given = docs(*[(i, f"x {shared}", f"s{i}") for i in range(3)], (9, f"é {own} secret: zzzzzzz", None))
    found = {r["doc_id"]: r for r in secrets.scan(given).collect()}
    assert [found[0][c] for c in ("n_assign", "n_live", "n_example", "most_owners", "spans")] == [1, 0, 1, 3, "assign:2:23"]
    assert [found[9][c] for c in ("n_assign", "n_live", "n_example", "spans")] == [0, 1, 0, "github:2:46"]
    copied = docs(*[(i, own, f"s{i}") for i in range(3)])
    assert {r["spans"] for r in secrets.scan(copied).collect()} == {""}


def test_many_secrets_in_one_text(docs):
    """The time of a text grows with its matches, not with their square."""
    text = "\n".join(f"row {i} é token={i:010d}x" for i in range(200_000))
    (row,) = secrets.scan(docs((1, text, "s"))).collect()
    assert (row["n_assign"], row["n_live"], row["n_access"]) == (200_000, 200_000, 0)
    spans = row["spans"].split(",")
    place = lambda i: len("".join(f"row {k} é token={k:010d}x\n" for k in range(i)))
    begin = place(1000) + len("row 1000 é ")
    assert spans[1000] == f"assign:{begin}:{begin + 17}"


@pytest.mark.parametrize(
    ("kind", "value"),
    [
        ("private_key", "-----BEGIN RSA PRIVATE KEY-----\nMIIab+/=\n-----END RSA PRIVATE KEY-----"),
        ("google", "AIza" + "Ab1_-" * 7),
        ("stripe", "sk_" + "live_" + "a1B2" * 5),
        ("sendgrid", "SG." + "a1B2_" * 4 + "." + "c3D4-" * 4),
        ("gitlab", "glpat" + "-" + "x_1y" * 5),
        ("npm", "npm_" + "aB3" * 12),
    ],
)
def test_formats_of_credentials(docs, kind, value):
    (row,) = secrets.scan(docs((1, f"é my {value} end", "s"))).collect()
    assert f"{kind}:5:{5 + len(value)}" in row["spans"].split(",")


# SentencePiece


def test_spans_cover_the_original_bytes(docs):
    text = " Größe  梦\n<s> ok"
    (row,) = sentencepiece.encode(docs((1, text)), MODEL).collect()
    data = text.encode()
    assert row["starts"][0] == 0 and row["ends"][-1] == len(data)
    assert all(a == b for a, b in zip(row["ends"], row["starts"][1:], strict=False))
    back = sentencepiece.decode(sentencepiece.encode(docs((1, text), (2, None)), MODEL), MODEL)
    assert rows_of(back, "doc_id", "text") == [(1, text), (2, "")]


def mapped_model(rule, trim):
    """The public model with a compiled character map in place of its own."""
    proto = sentencepiece_model_pb2.ModelProto()
    with open(MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    other = SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=trim, add_dummy_prefix=True, escape_whitespaces=True)
    spec = sentencepiece_model_pb2.ModelProto()
    spec.ParseFromString(other.serialized_model_proto())
    proto.normalizer_spec.CopyFrom(spec.normalizer_spec)
    return proto.SerializeToString()


@pytest.mark.parametrize(("rule", "trim"), [("identity", False), ("nfkc", True), ("nmt_nfkc_cf", False), ("nmt_nfkc_cf", True)])
def test_digests_project_every_piece(docs, tmp_path, rule, trim):
    model = mapped_model(rule, trim)
    path = tmp_path / "mapped.model"
    path.write_bytes(model)
    processor = SentencePieceProcessor(model_proto=model)
    draw = random.Random(2)
    texts = ["".join(draw.choice("aÅﬁ① \n梦　カ́e゙BC…x") for _ in range(draw.randint(0, 30))) for _ in range(200)]
    found = {r["doc_id"]: r for r in sentencepiece.digests(docs(*enumerate(texts)), str(path)).collect()}
    for at, text in enumerate(texts):
        pieces = processor.encode(text, return_type="proto").pieces
        spans = np.array([(p.id, p.begin, p.end) for p in pieces], "<i4").reshape(-1, 3)
        assert found[at]["n_tokens"] == len(spans)
        assert found[at]["ids_sha256"] == hashlib.sha256(",".join(str(p.id) for p in pieces).encode()).hexdigest()
        assert found[at]["n_bytes"] == int((spans[:, 2] - spans[:, 1]).sum())
        ends = sentencepiece.load(model).round_trip(text)[2]
        assert ends[:, 0].tolist() == spans[:, 0].tolist()
        if not trim:
            assert ends.tolist() == spans.tolist()


@pytest.mark.parametrize("rule", ["nfkc", "nmt_nfkc_cf"])
@pytest.mark.parametrize("trim", [True, False])
def test_normaliser_equals_the_library(rule, trim):
    other = SentencePieceNormalizer(rule_name=rule, remove_extra_whitespaces=trim, add_dummy_prefix=True, escape_whitespaces=True)
    proto = sentencepiece_model_pb2.ModelProto()
    proto.ParseFromString(other.serialized_model_proto())
    own = sentencepiece.Normalizer(proto.normalizer_spec)
    draw = random.Random(1)
    for _ in range(300):
        text = "".join(draw.choice("aÅﬁ①½ \t\n梦　カ́e゙ABC…") for _ in range(draw.randint(0, 20)))
        normalized, offsets = own.aligned(text)
        assert normalized == other.normalize(text)
        assert len(offsets) == len(normalized.encode()) + 1
        assert offsets == sorted(offsets)


# Line dedup

RUN = "\n".join(" ".join(f"w{k}{i}" for i in range(20)) for k in range(3))


def test_runs_go_but_their_first_place(docs):
    given = docs((1, f"own one\n{RUN}\nend"), (2, f"other\n{RUN}\n\nlast"), (3, RUN.split("\n")[0]), (0, "clean\nend"), (4, RUN))
    found = {r["doc_id"]: (r["text"], r["n_deleted"]) for r in lines.dedup(given).collect()}
    assert found[1] == (f"own one\n{RUN}\nend", 0)
    assert found[2] == ("other\nlast", 4)
    assert found[3][1] == found[0][1] == 0
    assert found[4] == ("", 3)


def test_the_two_ids_of_a_line_are_independent(spark):
    """Of lines that share 16 bits of one id about one in 65,536 shares those of the other."""
    lines_in = spark.range(200_000).selectExpr("CAST(id AS STRING) AS doc_id", "concat('line ', id) AS text")
    ids = lines.sequences(lines_in, "doc_id", "text").selectExpr("h & 65535 AS h", "g & 65535 AS g")
    both = ids.groupBy("h", "g").count().selectExpr("sum(count * (count - 1) / 2) AS n").first()["n"]
    assert both < 50
    one = ids.groupBy("h").count().selectExpr("sum(count * (count - 1) / 2) AS n").first()["n"]
    assert one > 200_000


def test_keys_and_texts_are_told_apart(spark):
    rows = [("a\nb", "c"), ("a", "b\nc"), (None, "x"), ("", "x"), ("-", "x"), ("1:a", "b"), ("1", "a:b")]
    found = spark.createDataFrame(rows, "k string, t string").select(lines.identity("k", "t").alias("i")).distinct().count()
    assert found == len(rows)


def test_many_cuts_in_one_text(docs):
    run = lambda k: " ".join(f"w{k}x{i}" for i in range(50))
    text = "\n".join(f"{run(k)}\nown {k}" for k in range(3_000))
    given = docs((1, "\n".join(run(k) for k in range(3_000))), (2, text))
    found = {r["doc_id"]: r for r in lines.dedup(given).collect()}
    assert found[2]["n_deleted"] == 3_000 and found[1]["n_deleted"] == 0
    assert found[2]["text"] == "\n".join(f"own {k}" for k in range(3_000))


def test_runs_of_any_depth(docs):
    short = "\n".join(f"line {i}" for i in range(70))
    found = {r["doc_id"]: r["n_deleted"] for r in lines.dedup(docs((1, short), (2, f"x\n{short}\ny"), (3, short[:100]))).collect()}
    assert found == {1: 0, 2: 70, 3: 0}


def test_ranks_ascend(spark):
    ids = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("a"), (F.col("id") % 7).alias("b"))
    ranks = [(r["a"], r["b"]) for r in lines.ranked(ids, "a", "b").orderBy("rank").collect()]
    assert ranks == sorted(ranks)


# Near-duplicates


def variants(n, drop):
    base = [f"w{i}" for i in range(200)]
    out = []
    for k in range(n):
        words = list(base)
        for at in drop(k):
            words[at] = f"z{k}x{at}"
        out.append(" ".join(words))
    return out


def plain_components(texts, width=2):
    sets = [minhash.shingles(minhash.words_of(t), width) for t in texts]
    label = list(range(len(texts)))
    for _ in texts:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and 100 * len(a & b) >= 80 * len(a | b):
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_components_equal_all_pairs(docs):
    draw = random.Random(5)
    texts = variants(25, lambda k: draw.sample(range(200), 6))
    texts += variants(10, lambda k: range(k * 3))
    texts += ["A b", "a  B", "a", "A", "", None, texts[3]]
    found = minhash.near_duplicates(docs(*enumerate(texts))).collect()
    expected = plain_components(texts)
    assert {r["doc_id"]: r["component_id"] for r in found} == dict(enumerate(expected))
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found)


def test_chains_are_one_component(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(100)] + [(200, 201), (300, 300), (None, 5)], "a long, b long")
    found = dict(rows_of(components.components(links), "node", "component"))
    assert found == {**dict.fromkeys(range(101), 0), 200: 200, 201: 200}


# Mixing


def test_caps_are_shared_out(docs):
    given = docs((1, "a b", "s"), *[(i, "x " * 100, "t") for i in range(2, 12)], (20, "y " * 500, None))
    found = {r["doc_id"]: r for r in mixing.allot(given).collect()}
    total = 2 + 1000 + 500
    assert found[1]["taken"] == found[1]["target"] == 6
    assert found[2]["target"] == pytest.approx((total - 6) * 2 / 3)
    assert found[20]["target"] == pytest.approx((total - 6) / 3)
    assert sum(r["taken"] for i, r in found.items() if 2 <= i < 12) == int((total - 6) * 2 / 3)
    assert all(r["taken"] <= 3 * r["size"] for r in found.values())
    mixed = mixing.mix(given)
    assert mixed.columns == given.columns
    words = {r["doc_id"]: r["n"] for r in mixed.groupBy("doc_id").agg(F.sum(mixing.word_count()).alias("n")).collect()}
    assert words == {i: r["taken"] for i, r in found.items() if r["taken"]}


def test_all_sources_capped(docs):
    found = mixing.allot(docs((1, "a b", "s"), (2, None, "s")), weights=(1,), cap=1).collect()
    assert rows_of(mixing.allot(docs((1, "a b", "s"), (2, None, "s")), weights=(1,), cap=1), "doc_id", "taken") == [(1, 2), (2, 0)]
    assert {r["target"] for r in found} == {2.0}


# Fingerprints


def test_branches_locate_edits(docs):
    one, two = "First. Second. Third.\nNext line.\n\nOther section.", "First. Changed. Third.\nNext line.\n\nOther section. More."
    marks = merkle.fingerprints(docs((1, one), (2, two), (3, one))).orderBy("doc_id").select("fingerprint").collect()
    assert marks[0] == marks[2] != marks[1]
    pair = docs((1, "")).select(F.lit(marks[0][0]).alias("a"), F.lit(marks[1][0]).alias("b"))
    (found,) = pair.select(merkle.edits(F.col("a"), F.col("b")).alias("e")).collect()
    assert found["e"] == ["0.0.1", "1.0.1"]


def test_the_last_is_followed_by_the_first(docs):
    found = {r["doc_id"]: r for r in merkle.compare_edited(docs((7, "a" * 8), (3, "b"), (None, "ccc"))).collect()}
    assert {i: r["next_id"] for i, r in found.items()} == {None: 3, 3: 7, 7: None}
    (alone,) = merkle.compare_edited(docs((7, "abcdefgh"))).collect()
    assert alone["n_chars"] == 8 and alone["next_id"] == 7 and alone["near_next"] == 1.0


# Neighbours


def test_vectors_that_take_no_part(spark):
    nan, inf = float("nan"), float("inf")
    given = spark.createDataFrame(
        [(0, [1.0, 0.0]), (1, [2.0, 0.0]), (2, [1.0, 1.0]), (3, None), (4, [0.0, 0.0]), (5, [nan, 1.0]), (6, [1.0, None])]
        + [(7, [inf, 1.0]), (8, [1.0, 0.0, 0.0]), (9, [3.0, 0.0]), (50, [0.0, 0.0]), (None, [1.0, 0.0]), (9, [3.0, 0.0])],
        "vec_id long, embedding array<float>",
    )
    found = neighbours.nearest(given).orderBy("query_id", "rank").collect()
    assert [(r["query_id"], r["rank"], r["vec_id"]) for r in found] == [(0, 1, 1), (0, 2, 9), (0, 3, 2)]
    assert neighbours.nearest(given.where("false")).collect() == []


def test_many_equal_vectors_and_blocks(spark):
    draw = np.random.default_rng(3)
    vectors = [(int(i), [1.0, 2.0, 3.0, 4.0] if i % 3 == 0 else draw.standard_normal(4).tolist()) for i in range(600)]
    given = spark.createDataFrame(vectors, "vec_id long, embedding array<double>")
    found = {}
    for r in neighbours.nearest(given, block=100).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"]))
    assert [i for _, i in sorted(found[150])] == [0, 3, 6, 9, 12]
    assert [i for _, i in sorted(found[0])] == [3, 6, 9, 12, 15]


# Toxicity


def test_examples_vote(docs, spark):
    texts = [(i, f"some plain words number{i % 7} {'you utter fool' if i % 4 == 0 else 'have a day'}") for i in range(200)]
    given = docs(*texts, (900, "such a fool"), (901, "such a day"), (902, None))
    labels = spark.createDataFrame([(i, int(i % 4 == 0)) for i in range(200)] + [(5, None)], "doc_id long, toxic int")
    found = {r["doc_id"]: r for r in toxicity.classify(given, labels).collect()}
    assert found[900]["predicted"] == 1 and found[900]["evidence"].count(":1:") == 3
    assert found[901]["predicted"] == 0 and found[902]["predicted"] == 0
    assert 0 <= found[902]["score"] < 0.5


@pytest.mark.parametrize("common", [0, 7, 50])
def test_blocks_skip_nothing_near(monkeypatch, common):
    monkeypatch.setattr(toxicity, "BLOCK", 8)
    monkeypatch.setattr(toxicity, "COMMON", common)
    monkeypatch.setattr(toxicity, "FIRST_SHARE", 0.1)
    draw = np.random.default_rng(1)
    vectors = []
    for _ in range(300):
        terms = np.sort(draw.choice(50, 5, replace=False))
        weights = draw.random(5)
        vectors.append((terms, weights / np.sqrt(weights @ weights)))
    labels = [int(i % 5 == 0) for i in range(300)]
    index = toxicity.Index(vectors, labels, 50)
    dense = np.zeros((300, 50))
    for row, (terms, weights) in zip(dense, vectors, strict=True):
        row[terms] = weights
    found = index.nearest(vectors[:40], 15)
    alone = index.nearest(vectors[:40], 15, [int(s) for s in index.slots[:40]])
    for at, (terms, weights) in enumerate(vectors[:40]):
        query = np.zeros(50)
        query[terms] = weights
        for label in (0, 1):
            cosines = [(s, i) for i, s in enumerate(dense @ query) if s > 0 and labels[i] == label]
            assert [c for c, _ in found[at][label]] == pytest.approx(sorted((s for s, _ in cosines), reverse=True)[:15], abs=1e-6)
            others = sorted((s for s, i in cosines if i != at), reverse=True)[:15]
            assert [c for c, _ in alone[at][label]] == pytest.approx(others, abs=1e-6)
            assert all(dense[list(index.slots).index(slot)] @ query == pytest.approx(c, abs=1e-6) for c, slot in found[at][label])


def plain_shares(texts, examples, all_texts, without=()):
    """The toxic share of the votes, by plain dictionaries."""
    words = lambda t: re.findall(r"[^\W\d_]+", t.lower())
    terms = lambda t: Counter(w[:n] for w in words(t) for n in (4, 5) if len(w) >= n)
    vocabulary = {t for x, _ in examples for t in terms(x)}
    df = Counter(t for x in all_texts for t in terms(x) if t in vocabulary)
    idf = {t: math.log((1 + len(all_texts)) / (1 + df[t])) + 1 for t in vocabulary}

    def unit(x):
        v = {t: n * idf[t] for t, n in terms(x).items() if t in vocabulary}
        norm = math.sqrt(sum(w * w for w in v.values())) or 1
        return {t: w / norm for t, w in v.items()}

    held, shares = [(unit(x), y) for x, y in examples], []
    for at, text in enumerate(texts):
        v, means = unit(text), []
        for label in (0, 1):
            cosines = [sum(w * e.get(t, 0) for t, w in v.items()) for i, (e, y) in enumerate(held) if y == label and (i != at or not without)]
            places = min(15, len(cosines))
            means.append(sum(c**8 for c in sorted(cosines, reverse=True)[:15]) / max(places, 1))
        shares.append(means[1] / sum(means) if sum(means) else None)
    return shares


def test_scores_equal_plain_voting(docs, spark):
    draw = random.Random(6)
    plain = ["".join(draw.choice("abcdefé") for _ in range(draw.randint(3, 7))) for _ in range(60)]
    prose = lambda: " ".join(draw.choice(plain) for _ in range(30))
    keys = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5][:120]
    texts = [f"{prose()} {'Grobian!' if draw.random() < 0.8 and at % 3 == 0 else 'friendly'} {prose()}" for at in range(120)]
    asked = [f"{prose()} {draw.choice(['grobians', 'friends', ''])}" for _ in range(40)]
    answers = [int(at % 3 == 0) for at in range(120)]
    given = docs(*zip(keys, texts, strict=True), *((1000 + i, t) for i, t in enumerate(asked)))
    labels = spark.createDataFrame(list(zip(keys, answers, strict=True)), "doc_id long, toxic int")
    found = {r["doc_id"]: r["score"] for r in toxicity.classify(given, labels).collect()}
    examples = sorted(zip(map(str, keys), texts, answers, strict=True), key=lambda e: (e[2], e[0]))
    examples = [(t, y) for _, t, y in examples]
    own = plain_shares([t for t, _ in examples], examples, texts + asked, without=True)
    knots = toxicity.isotonic(np.array(own), np.array([y for _, y in examples], float), np.ones(120), 40 / 120)
    for i, share in enumerate(plain_shares(asked, examples, texts + asked)):
        assert found[1000 + i] == pytest.approx(float(np.interp(share, *knots)), abs=1e-4)


def test_isotonic_levels():
    x, y = np.array([0.1, 0.2, 0.3, 0.4, 0.4, 0.9]), np.array([0, 1, 0, 1, 0, 1.0])
    at, level = toxicity.isotonic(x, y, np.ones(6), 0.5)
    assert list(level) == sorted(level) and list(at) == sorted(at)
    assert level[0] == pytest.approx(0.5 / 2) and level[-1] == pytest.approx(1.5 / 2)
    # Between them 0.2 to 0.4 pool: two of four are toxic.
    assert level[1] == pytest.approx(2.5 / 5)


def test_long_examples_are_not_drawn(docs, spark):
    keys = [i for i in range(100) if zlib.crc32(str(i).encode()) % 5][:40]
    texts = [(k, f"{'grobian' if at % 2 else 'friendly'} text") for at, k in enumerate(keys)]
    long = (keys[0], "grobian " * 10_000)
    labels = spark.createDataFrame([(k, at % 2) for at, k in enumerate(keys)], "doc_id long, toxic int")
    model = toxicity.fit(docs(long, *texts[1:]), labels)
    assert model.sizes == (19, 20)
    assert max(map(len, model.vocabulary)) <= 5


def test_few_labels_still_tell(docs, spark):
    """Five toxic rows teach a word that stands out in them. By plain cosine a word said once among twenty does not."""
    draw = random.Random(4)
    plain = ["".join(draw.choice("abcdefghijkl") for _ in range(7)) for _ in range(400)]
    prose = lambda n: " ".join(draw.choice(plain) for _ in range(n))
    keys = [i for i in range(200) if zlib.crc32(str(i).encode()) % 5][:40]
    texts = [(k, f"{prose(8)} {'you grobian, grobian, grobian' if at < 5 else 'and so'} {prose(4)}") for at, k in enumerate(keys)]
    asked = [(1000 + i, f"{prose(8)} {'you grobian, grobian, grobian' if i < 10 else 'and so'} {prose(4)}") for i in range(20)]
    labels = spark.createDataFrame([(k, int(at < 5)) for at, k in enumerate(keys)], "doc_id long, toxic int")
    found = {r["doc_id"]: r["predicted"] for r in toxicity.classify(docs(*texts, *asked), labels).collect()}
    assert sum(found[1000 + i] for i in range(10)) >= 8
    assert sum(found[1010 + i] for i in range(10)) <= 2


def test_no_term_is_crowded_out(docs, spark):
    """Thousands of words that more toxic rows hold don't cost a rarer one its place."""
    keys = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5][:100]
    common = [f"{a}{b}{c}" for a in "abcdefghijklmnopq" for b in "abcdefghijklmnopq" for c in "abcdefghijklmnopq"]

    def text(at):
        rare = "schuft" if at < 9 else ""
        return f"{' '.join(common) if at < 50 and at % 5 else 'plain'} {rare}"

    labels = spark.createDataFrame([(k, int(at < 50)) for at, k in enumerate(keys)], "doc_id long, toxic int")
    given = docs(*((k, text(at)) for at, k in enumerate(keys)), (1000, "schuft"))
    row = {r["doc_id"]: r for r in toxicity.classify(given, labels).collect()}[1000]
    assert row["evidence"].count(":1:") == 3
    assert row["predicted"] == 1


def test_words_are_encoded_once_whatever_marks_follow(monkeypatch):
    model = sentencepiece.Model(sentencepiece.read_model(MODEL))
    merged, split = [], model._split
    monkeypatch.setattr(model, "_split", lambda text: merged.append(text) or split(text))
    text = " ".join(f"onenndthou{marks}" for marks in ("", ",", "!!", "***", "...&&&", "漢", "▁▁")) + " naïveté▁漢字."
    ids, decoded, _ = model.round_trip(text)
    library = SentencePieceProcessor(model_file=MODEL)
    assert ids == ",".join(map(str, library.encode(text)))
    assert decoded == library.decode(library.encode(text))
    assert sum("onenndthou" in m for m in merged) == 1


def test_chunks_are_remembered_as_long_as_the_task(docs, monkeypatch):
    monkeypatch.setattr(sentencepiece, "map_rows", lambda df, columns, schema, make: make)
    make = sentencepiece.digests(docs((1, "x")), MODEL)
    assert make()("some words, once remembered", 1) == make()("some words, once remembered", 1)
    assert not sentencepiece.load(sentencepiece.read_model(MODEL)).known


def test_few_words_are_remembered():
    signer = minhash.Signer(2)
    for k in range(2):
        signer.hashes([b"%d-%d" % (k, n) for n in range(120_000)])
    assert len(signer.known) <= 120_000
