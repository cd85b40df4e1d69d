"""Conversation repair, byte-level BPE and whitening against brute force, on awkward rows and hot groups."""

import base64
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import regex
import tiktoken
from pyspark.sql import functions as F

from comanda.llm import byte_bpe, conversation_repair, queries, whitening

# ---- conversation repair -----------------------------------------------------------------------------------

SPACE = " \t\n\x0b\x0c\r"
STEP = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        fault = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if fault:
            text = {1: "", 2: re.sub("[.!?]", "", text)}.get(fault, text)
            out += [(conv, turn, "user" if fault == 4 else role, text)] * (2 if fault == 3 else 1)
    return out


def cheapest(rows):
    """(cost, audit, lines) of rows (initial role text fault), by trying every edit: the least (cost, audit) of each state."""
    best = {"": (0, "", ())}

    def inserted(states):
        for _ in range(3):
            for at, (cost, audit, lines) in list(states.items()):
                for role in ("user", "assistant"):
                    if (at, role[0]) in STEP:
                        new = (cost + 5, audit + "I", (*lines, f"{role}:"))
                        states[STEP[at, role[0]]] = min(states.get(STEP[at, role[0]], new), new)
        return states

    for role, text, fault in rows:
        after = {}
        for at, (cost, audit, lines) in inserted(dict(best)).items():
            ways = [(2, "D", at, ())]
            if fault not in ("blank", "duplicate"):
                more = 5 if fault == "truncated" else 0
                ways += [(more, "K", STEP[at, role[:1]], (f"{role}:{text}",))] if (at, role[:1]) in STEP else []
                ways += [(1 + more, "R", STEP[at, r[0]], (f"{r}:{text}",)) for r in ("user", "assistant") if (at, r[0]) in STEP]
            for c, letter, state, line in ways:
                new = (cost + c, audit + letter, (*lines, *line))
                after[state] = min(after.get(state, new), new)
        best = after
    ends = inserted(dict(best))
    return min(ends[at] for at in ("", "a") if at in ends)


def reports(rows):
    out = {}
    for conv in {r[0] for r in rows}:
        own = sorted((r for r in damaged(rows) if r[0] == conv), key=lambda r: (
            r[1] is not None, r[1] or 0, r[2], hashlib.sha256(r[3].encode()).digest()))
        seen, judged = set(), []
        for _, _, role, text in own:
            last = text.rstrip(SPACE)[-1:]
            judged.append((role, text, "blank" if not last else "duplicate" if (role, text) in seen else
                           "truncated" if last not in ".!?" else ""))
            seen.add((role, text))
        faults = [f for *_, f in judged]
        turns = [t for _, t, *_ in own if t is not None]
        cost, audit, lines = cheapest(judged)
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(judged, judged[1:])), cost, audit,
            hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


COLUMNS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def repaired(spark, tmp_path, rows, schema="conv_id long, turn long, role string, text string"):
    df = spark.createDataFrame(rows, schema)
    df.withColumn("line", F.lit(1)).withColumn("place", F.lit("x")).write.parquet(f"{tmp_path}/conversations.parquet")
    found = queries.op11_conversation_repair(spark, str(tmp_path)).collect()
    assert len(found) == len({r[0] for r in rows})
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in found}


def test_repair_of_random_conversations(spark, tmp_path):
    rng = random.Random(3)
    texts = ["Yes.", "No!", "open end", "", " \t", None, "Why?  ", "naïve 😀.", "a\x1f", "Long " * 50 + "."]
    rows = [(rng.choice([None, *range(40)]), rng.choice([None, *range(9)]), rng.choice(
        ["system", "user", "assistant", "user", "assistant", "tool", "", None]), rng.choice(texts)) for _ in range(500)]
    assert repaired(spark, tmp_path, rows) == reports(rows)


def test_repair_of_one_hot_conversation_and_of_copies(spark, tmp_path):
    """A conversation with a third of all rows is cut into pieces; one row of it stands there hundreds of times."""
    rng = random.Random(4)
    rows = [(7, t, rng.choice(["user", "assistant", "system", "x"]), rng.choice(["Yes.", f"Text {t}.", f"cut {t}"])) for t in range(900)]
    rows += [(7, 450, "user", "again.")] * 300
    rows += [(100 + i // 6, i % 6, ("user", "assistant")[i % 2], f"Line {i}.") for i in range(2400)]
    assert repaired(spark, tmp_path, rows) == reports(rows)


def test_repair_of_nothing(spark, tmp_path):
    assert repaired(spark, tmp_path, []) == {}
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    report, lines = conversation_repair.repair(conversation_repair.damage(spark.createDataFrame(
        [(gone, 0, "user", "Hi.")], "conv_id long, turn long, role string, text string")))
    assert report.collect() == lines.collect() == []


def test_repaired_rows(spark):
    rows = [("c", 1, "system", "Be kind."), ("c", 2, "assistant", "Hello."), ("c", 3, "user", "Bye."), ("c", 4, "user", "Bye.")]
    report, lines = conversation_repair.repair(spark.createDataFrame(rows, "conv_id string, turn int, role string, text string"))
    assert [tuple(r) for r in report.collect()] == [("c", 0, 0, 1, 0, 2, 4, "KRRD")]
    assert [tuple(r) for r in lines.orderBy("line").collect()] == [
        ("c", 0, "K", 1, "system", "Be kind."), ("c", 1, "R", 2, "user", "Hello."), ("c", 2, "R", 3, "assistant", "Bye.")]


@pytest.mark.parametrize("size", [1, 5, 63, 64, 65, 1000])
def test_pieces_together_are_the_whole(size):
    rng = random.Random(size)
    classes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 8, 9, 12, 4, 8]) for _ in range(size))
    rows = [(["system", "user", "assistant", "x"][c // 4], "t", ["", "truncated", "blank", "duplicate"][c % 4]) for c in classes]
    cost, audit, _ = cheapest(rows)
    assert conversation_repair.cheapest(conversation_repair.piece_ways(classes)) == (cost, audit)
    cuts = sorted({0, size, *(rng.randrange(size) for _ in range(4))})
    parts = [conversation_repair.piece_ways(classes[a:b]) for a, b in zip(cuts, cuts[1:])]
    assert conversation_repair.cheapest(conversation_repair.together(parts)) == (cost, audit)


# ---- byte-level BPE ----------------------------------------------------------------------------------------

PATH = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


@pytest.fixture(scope="module")
def vocabulary():
    return byte_bpe.Vocabulary.read(PATH, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def library():
    with open(PATH, "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


STRANGE = [
    None, "", " ", "\n\n  x", "don't we'll IT'S", "a" * 30_000, "ab" * 9_000 + " " * 5_000, "😀 naïve Ünïcode \x1f\x00text",
    "<|endoftext|> end", "՘a࢏1 \U0003d000x!\U000323b0", "१२३ ٣٤ ½ Ⅻ", "ᲉꟋ mixed lines　", "tail  ",
    "".join(chr(c) for c in range(0x20, 0x3000, 7)),
]


def encoded(df, vocabulary):
    found = byte_bpe.decode(byte_bpe.encode(df, vocabulary), vocabulary)
    return [(r["doc_id"], np.frombuffer(r["ids"], "<u4").tolist(), bytes(r["decoded"])) for r in found.collect()]


def test_ids_are_the_librarys(spark, vocabulary, library, awkward, clashing, monkeypatch):
    monkeypatch.setattr(byte_bpe, "BLOCK_BYTES", 40_000)
    monkeypatch.setattr(byte_bpe, "SHARD_BYTES", 20_000)
    strange = spark.createDataFrame([(i, t) for i, t in enumerate(STRANGE)], "doc_id long, text string")
    hot = spark.createDataFrame([(i, "the same words over and over" if i % 3 else f"own text {i}") for i in range(900)], "doc_id long, text string")
    for df in (strange, hot.repartition(5), awkward, clashing):
        want = [(r["doc_id"], library.encode_ordinary(r["text"] or ""), (r["text"] or "").encode()) for r in df.select("doc_id", "text").collect()]
        assert sorted(encoded(df, vocabulary), key=repr) == sorted(want, key=repr)
        both = byte_bpe.round_trip(df, vocabulary).collect()
        assert sorted(((r[0], np.frombuffer(r[1], "<u4").tolist(), bytes(r[2])) for r in both), key=repr) == sorted(want, key=repr)


def test_bpe_of_nothing(spark, vocabulary, nothing):
    assert encoded(nothing, vocabulary) == []
    only_null = spark.createDataFrame([("a", None), (None, "")], "doc_id string, text string")
    assert sorted(encoded(only_null, vocabulary), key=str) == [("a", [], b""), (None, [], b"")]


def test_words_of_any_length(vocabulary, library):
    rng = random.Random(5)
    for size in (1, 2, 7, 47, 48, 49, 400):
        for _ in range(30):
            word = "".join(rng.choice("aeiourstnl") for _ in range(size))
            assert byte_bpe.encode_word(word.encode(), vocabulary.ranks) == library.encode_ordinary(word)


def test_pre_tokens_with_new_letters(vocabulary):
    compiled = regex.compile(vocabulary.pattern)
    assert byte_bpe.pieces("a՘b c", compiled) == ["a", "՘", "b", " c"]
    assert "".join(byte_bpe.pieces(STRANGE[-1], compiled)) == STRANGE[-1]


def test_too_large_vocabulary_and_unknown_ids(spark, tmp_path, vocabulary, monkeypatch):
    monkeypatch.setattr(byte_bpe, "MAX_VOCABULARY", 10)
    with pytest.raises(ValueError, match="too many"):
        byte_bpe.Vocabulary.read(PATH, "x")
    with pytest.raises(Exception, match="no bytes|out of bounds"):
        byte_bpe.decode(spark.createDataFrame([(bytearray(b"\xff\xff\x00\x00"),)], "ids binary"), vocabulary).collect()


# ---- whitening ---------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, whitened string, x int"


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "clash", 1) for i, v in rows], VECTORS).repartition(3)


def brute(rows, k=32):
    x = np.array([np.floor(np.array(v, np.float32).astype(np.float64) * 64) + 1_000_000 for _, v in rows]).astype(np.int64)
    n, s = len(x), x.sum(0)
    centred = (x - s / n)
    e, u = np.linalg.eigh(centred.T @ centred / n)
    e, u = e[::-1][:k], u[:, ::-1][:, :k]
    deviation = [sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s)) for row in x]
    return centred @ u / np.sqrt(e), e / np.trace(centred.T @ centred / n), deviation


def test_whitening_is_that_of_the_eigenvectors(spark):
    rng = np.random.default_rng(6)
    mix = rng.normal(size=(40, 40)) * np.geomspace(3, 0.05, 40)
    rows = [(i, (rng.normal(size=40) @ mix).tolist()) for i in range(300)]
    rows += [(1000 + i, rows[0][1]) for i in range(150)]  # a third of all vectors are one
    bad = [(2000, None), (2001, [None] * 40), (2002, [float("nan")] * 40), (2003, [float("inf")] + [0.0] * 39), (2004, [1.0]), (2005, [])]
    found = whitening.whiten(vectors(spark, rows + bad)).orderBy("vec_id", "component").toPandas()
    want, explained, deviation = brute(rows)
    assert len(found) == 450 * 32 and found["n"].unique().tolist() == [450]
    mine = found["whitened"].to_numpy().reshape(450, 32)
    assert np.abs(mine * np.sign((mine * want).sum(0)) - want).max() < 1e-8
    assert np.allclose(found["explained"][:32], explained, rtol=1e-9)
    assert found["deviation"].to_numpy().reshape(450, 32)[:, 0].tolist() == deviation
    assert found["identity_error"].nunique() == 1 and 0 <= found["identity_error"][0] < 1e-10


def test_whitening_of_low_rank_and_of_nothing(spark):
    flat = [(i, [float(i % 7), 2.0 * (i % 7), 0.5]) for i in range(20)] + [(None, [0.0, 0.0, 0.5])]
    found = whitening.whiten(vectors(spark, flat)).collect()
    assert {r["component"] for r in found} == {1} and len(found) == 21 and abs(found[0]["explained"] - 1) < 1e-12
    for rows in ([], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0]), (2, [1.0, 2.0])], [(1, [])]):
        assert whitening.whiten(vectors(spark, rows)).collect() == []


def test_jacobi_keeps_small_eigenvalues():
    """Eigenvalues over twelve powers of ten, to almost all digits, where they are scaled badly."""
    rng = np.random.default_rng(7)
    q, _ = np.linalg.qr(rng.normal(size=(12, 12)))
    scale = np.geomspace(1, 1e-6, 12)
    base = q @ np.diag(np.linspace(1, 2, 12)) @ q.T
    c = base * np.outer(scale, scale)
    factor = whitening.pivoted_cholesky(c)
    assert factor.shape == (12, 12) and np.allclose(factor @ factor.T, c, rtol=1e-12, atol=0)
    values, components = whitening.one_sided_jacobi(factor)
    assert np.abs(components.T @ components - np.eye(12)).max() < 1e-13
    assert (np.diff(values) <= 0).all()
    # the product of the eigenvalues is the determinant, which is known
    assert np.isclose(np.log(values).sum(), np.linalg.slogdet(base)[1] + 2 * np.log(scale).sum(), rtol=1e-12)


def test_sums_beyond_doubles_are_exact():
    y = np.array([[2**40 + 1, -3], [2**40, 5]], np.int64)
    assert whitening._exact_product(y)[0, 0] == (2**40 + 1) ** 2 + 2**80
    assert whitening._exact_product(np.array([[2**25 + 1] * 2] * 9, np.int64))[0, 1] == 9 * (2**25 + 1) ** 2
    assert whitening._deviation(np.array([[2**40, 1]], np.int64), 2**30, [0, 0]) == [None]
    assert whitening._deviation(np.array([[3, 1]], np.int64), 10, [2, -1]) == [28**2 + 11**2]
