import re

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import functions as F

import corpus_pipeline
from tickflow.llm.pieces import PieceModel, cut_units, decode_pieces, encode_pieces
from tickflow.llm.queries_free import PIECE_MODEL

TEXTS = ["", "  ", "a\nb c", "  lead", "tail  ", "\0a", "\r\n x", "日本🎉\t é", "x" * 500, " \n \n"]
TEXTS += ["ab" * 3000, "<s> </s> <unk>", "<0x0A>", "one " * 300]


#: A word with the spaces before it, a line feed, or spaces at the end.
UNIT = re.compile(r" *[^ \n]+| +|\n")


def test_units(documents):
    texts = [*TEXTS, None, "a", " \n", "", "é  \n\n  日 "]
    texts += [r.text for r in documents.select("text").limit(60).collect()]
    want = [UNIT.findall(" " + t) if t else [] for t in texts]
    units, counts = cut_units(pa.array(texts))
    assert units.to_pylist() == sum(want, []) and counts.tolist() == [len(u) for u in want]
    part = cut_units(pa.array(texts).slice(3, 9))
    assert part[0].to_pylist() == sum(want[3:12], []) and len(cut_units(pa.array([], pa.string()))[0]) == 0


def agenda(model, scores, unit, coin):
    """Merge-dropout of one word, as plainly as can be: best kept pair first, leftmost of equals."""
    symbols = [(i, i + 1) for i in range(len(unit))]
    skipped = set()
    piece = lambda a, b: unit[a:b].replace("\u2581", "\0").replace(" ", "\u2581")
    while True:
        best = None
        for (a, m), (m2, b) in zip(symbols, symbols[1:]):
            if (a, m, b) in skipped or piece(a, b) not in scores:
                continue
            span = np.array([(a << 42) + (m << 21) + b])
            if model._skipped(np.array([coin], dtype=np.uint64), model._hashed(span))[0]:
                skipped.add((a, m, b))
                continue
            if best is None or scores[piece(a, b)][1] > best[0]:
                best = (scores[piece(a, b)][1], a, m, b)
        if best is None:
            break
        _, a, m, b = best
        at = symbols.index((a, m))
        symbols[at : at + 2] = [(a, b)]
    out = []
    for a, b in symbols:
        known = scores.get(piece(a, b))
        out += [known[0]] if known else [model.byte_ids[x] for x in unit[a:b].replace(" ", "\u2581").encode()]
    return out


def test_dropout_is_a_plain_agenda(documents):
    """Each word's ids are those of the agenda that its coins leave."""
    from sentencepiece import sentencepiece_model_pb2

    proto = sentencepiece_model_pb2.ModelProto()
    with open(PIECE_MODEL, "rb") as file:
        proto.ParseFromString(file.read())
    scores = {p.piece: (i, p.score) for i, p in enumerate(proto.pieces) if p.type == 1}
    texts = ["the quick  brown fox\n " * 3, "aaaaaaa banana \u2581 日本é 🎉", "antidisestablishment " * 4]
    texts += [r.text[:300] for r in documents.select("text").limit(8).collect() if r.text]
    places = list(range(len(texts)))
    for dropout in (0.1, 0.5):
        model = PieceModel(PIECE_MODEL, 3, dropout)
        units, counts = cut_units(pa.array(texts))
        coins = model._coins(counts, places, None)
        want, at = [], 0
        for n in counts.tolist():
            own = zip(units[at : at + n].to_pylist(), coins[at : at + n], strict=True)
            want.append(sum((agenda(model, scores, u, c) for u, c in own), []))
            at += n
        for _ in range(2):
            assert [ids(x) for x in model.encode(texts, places)] == want


def test_decoding_in_batches():
    model = PieceModel(PIECE_MODEL, 1, 0.1)
    texts = [*TEXTS, "▁ x"]
    flat = [ids(x) for x in model.encode(texts, [0] * len(texts))]
    flat += [[], [model.byte_ids[0xFF]], [3, 300], [model.byte_ids[0xE2], 400, 5]]
    bounds = np.cumsum([0, *map(len, flat)])
    got = model.decode_all(np.array(sum(flat, []), dtype=np.int64), bounds)
    assert got.to_pylist() == [model.decode(x) for x in flat]
    got = model.decode_all(np.array(sum(flat[:-3], []), dtype=np.int64), bounds[:-3])
    assert got.to_pylist() == [*texts, ""]


def ids(raw):
    return np.frombuffer(raw, dtype="<i4").tolist()


def test_without_dropout_as_the_library(documents):
    texts = TEXTS + [r.text for r in documents.select("text").limit(60).collect()]
    own = PieceModel(PIECE_MODEL, 1, 0.0, 1).encode(texts, [0] * len(texts))
    library = sentencepiece.SentencePieceProcessor(model_file=PIECE_MODEL)
    assert [ids(x) for x in own] == library.encode(texts)


def test_dropout_is_seeded_varied_and_lossless():
    texts = [*TEXTS, "▁ x ▁▁ y", "the quick brown fox jumps over the lazy dog " * 40]
    places = list(range(len(texts)))
    model = PieceModel(PIECE_MODEL, 1, 0.1, 4)
    one = model.encode(texts, places)
    assert [model.decode(ids(x)) for x in one] == texts
    assert PieceModel(PIECE_MODEL, 1, 0.1, 4).encode(texts[::-1], places[::-1])[::-1] == one
    other = PieceModel(PIECE_MODEL, 2, 0.1, 4).encode(texts, places)
    plain = PieceModel(PIECE_MODEL, 1, 0.0, 1).encode(texts, places)
    assert one[-1] != other[-1] != plain[-1] and [model.decode(ids(x)) for x in other] == texts
    assert len(plain[-1]) < len(one[-1]) < 1.5 * len(plain[-1])
    letters = PieceModel(PIECE_MODEL, 1, 1.0, 4).encode(["abc de"], [0])[0]
    assert len(ids(letters)) == len("▁abc▁de")


def test_only_kept_merges_are_made():
    """Every pair that could still merge at the end was skipped by its coin."""
    model = PieceModel(PIECE_MODEL, 5, 0.3, 2)
    units = [" international", " unbelievable", "word", " a", "antidisestablishment"]
    plain = PieceModel(PIECE_MODEL, 5, 0.0, 1)
    for variant in (0, 1):
        for unit, raw in zip(units, model.segment(units, np.full(5, variant)), strict=True):
            assert b"".join(model.bytes[i] for i in ids(raw)).decode() == unit
            assert len(ids(raw)) >= len(ids(plain.segment([unit], np.zeros(1))[0]))


def test_kept_words_are_segmented_by_their_own_coins():
    """Going on from kept states gives what each occurrence's coins give on their own."""
    words = [" international", " unbelievable", " a", "\n", " antidisestablishment", " 日本é"]
    texts = [("".join(words) * 40)[1:], "x" * 500, *TEXTS]
    cut = [UNIT.findall(" " + text) if text else [] for text in texts]
    flat, counts = sum(cut, []), np.array([len(units) for units in cut])
    for dropout in (0.1, 0.6, 1.0):
        model = PieceModel(PIECE_MODEL, 5, dropout)
        for places in (list(range(len(texts))), [3 * i + 9 for i in range(len(texts))]):
            direct = b"".join(model.segment(flat, model._coins(counts, places, None)))
            assert b"".join(model.encode(texts, places)) == direct
            assert b"".join(model.encode(texts, places)) == direct


def test_each_occurrence_has_coins_of_its_own(spark):
    word = "antidisestablishment"
    model = PieceModel(PIECE_MODEL, 1, 0.1)
    assert len(set(model.encode([word] * 400, list(range(400))))) > 8
    assert len(set(model.encode([word] * 400, [7] * 400, list(range(400))))) > 8
    lines = model.encode(["\n".join([word] * 400)], [7])[0].split(model.encode(["\n"], [0])[0][4:])
    assert len(set(lines)) > 8
    alike = spark.createDataFrame([(4 * i, "some words of a text " * 9) for i in range(20)], "doc_id long, text string")
    assert encode_pieces(alike, PIECE_MODEL).distinct().count() == 20


def test_copies_of_a_document_differ(spark):
    rows = [(i % 4, f"document {i % 4} " + "that is used in several epochs " * 9) for i in range(12)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = corpus_pipeline.segment(spark, docs, "").select("doc_id", "ids")
    assert found.distinct().count() == 12
    again = corpus_pipeline.segment(spark, docs.repartition(5), "").select("doc_id", "ids")
    assert found.exceptAll(again).count() == 0


def test_frames(edge, empty):
    encoded = encode_pieces(edge.withColumnRenamed("ids", "old"), PIECE_MODEL, carry=("doc_id", "text"))
    carried = encoded.withColumnRenamed("text", "original")
    back = decode_pieces(carried, PIECE_MODEL, carry=("doc_id", "original"))
    assert back.count() == edge.count()
    assert back.filter(F.col("text") != F.coalesce("original", F.lit(""))).count() == 0
    assert encode_pieces(empty, PIECE_MODEL).count() == 0
    assert decode_pieces(encode_pieces(empty, PIECE_MODEL), PIECE_MODEL).count() == 0
