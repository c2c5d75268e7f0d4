import math
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tickflow.llm.language import LanguageSpec, codewords, gram_counts, identify, train
from tickflow.llm.queries_free import held_out
from tickflow.llm.shingles import string_buffers


def places_of(text, spec):
    """Places of a text's n-grams, one at a time."""
    raw = text.lower().encode()
    letters = [b if b >= 128 or 97 <= b <= 122 else 32 for b in raw]
    for size in spec.sizes:
        for i in range(len(letters) - size + 1):
            gram = letters[i : i + size]
            if (size == 1 and gram[0] == 32) or 32 in gram[1:-1] or (size == 2 and gram == [32, 32]):
                continue
            code = size
            for b in gram:
                code = ((code ^ b) * 0x9E3779B1) % 2**32
                code ^= code >> 15
            yield code >> (32 - spec.hash_bits)


def plain_model(rows, spec):
    """Shares per language, the bits' log-odds, and their trust, by loops."""
    langs = sorted({lang for _, lang in rows})
    count = {lang: Counter() for lang in langs}
    for text, lang in rows:
        count[lang].update(places_of(text, spec))
    share = {}
    for lang in langs:
        total = sum(count[lang].values()) + spec.smoothing * spec.places
        share[lang] = lambda p, c=count[lang], t=total: (c[p] + spec.smoothing) / t
    seen = sorted(set().union(*count.values()))
    code = codewords(len(langs), spec)
    odds, trust = [], []
    for b in range(code.shape[1]):
        on = [x for x, bit in zip(langs, code[:, b]) if bit]
        off = [x for x in langs if x not in on]
        mean = lambda p, xs: sum(share[x](p) for x in xs) / len(xs)
        odds.append(lambda p, on=on, off=off: math.log(mean(p, on)) - math.log(mean(p, off)))
        blank = spec.places - len(seen)
        unseen = next(p for p in range(spec.places) if p not in set(seen))
        margins = []
        for x, bit in zip(langs, code[:, b]):
            m = sum(share[x](p) * odds[b](p) for p in seen) + blank * share[x](unseen) * odds[b](unseen)
            margins.append(m if bit else -m)
        trust.append(max(min(margins), 1e-6))
    return langs, code, odds, [t * len(trust) / sum(trust) for t in trust]


def plain_verdict(text, model, spec):
    langs, code, odds, trust = model
    if not text or not any(c.isalpha() for c in text):
        return "und", 0.0
    grams = list(places_of(text, spec))
    evidence = min(len(grams), spec.full_evidence) / max(len(grams), 1)
    margin = [evidence * sum(o(p) for p in grams) for o in odds]
    loss = []
    for row in code:
        signed = [-m if bit else m for m, bit in zip(margin, row)]
        loss.append(sum(t * (max(x, 0) + math.log1p(math.exp(-abs(x)))) for t, x in zip(trust, signed)))
    best = loss.index(min(loss))
    return langs[best], 1 / sum(math.exp(min(loss) - x) for x in loss)


@pytest.mark.parametrize("langs", [("de", "en"), ("de", "en", "es", "fr")])
def test_against_a_plain_count_and_decode(spark, documents, langs):
    spec = LanguageSpec(hash_bits=10)
    rows = [(r.text[:400], r.lang) for r in documents.orderBy("doc_id").collect() if r.text and r.lang in langs]
    learned, tried = rows[:40], [t for t, _ in rows[40:70]] + [None, "", "12 34", "a", "É", "Zz 9 zz", "ü" * 300]
    model = train(spark.createDataFrame(learned, "text string, lang string"), spec)
    plain = plain_model(learned, spec)
    docs = spark.createDataFrame(list(enumerate(tried)), "doc_id long, text string")
    found = {r.doc_id: (r.lang_pred, r.score) for r in identify(docs, model).collect()}
    for i, text in enumerate(tried):
        lang, score = plain_verdict(text, plain, spec)
        assert found[i][0] == lang and abs(found[i][1] - score) < 1e-6, (text, found[i], lang, score)


def test_spans_change_no_count(monkeypatch):
    spec = LanguageSpec(hash_bits=8)
    texts = ["", "Hallo, Welt! " * 9, "x", "日本 é ab", "", "ab" * 50]
    raw, offsets = string_buffers(pa.array([t.lower() for t in texts]))
    group = np.array([0, 1, 0, 2, 1, 2])
    whole = gram_counts(raw, offsets, group, 3, spec)
    for span in (1, 5, 64):
        monkeypatch.setattr("tickflow.llm.language.SPAN", span)
        assert (gram_counts(raw, offsets, group, 3, spec) == whole).all()
    want = [Counter(), Counter(), Counter()]
    for t, g in zip(texts, group):
        want[g].update(places_of(t, spec))
    assert [{i: n for i, n in enumerate(row) if n} for row in whole.tolist()] == want


def test_codewords_stay_apart():
    spec = LanguageSpec()
    for n, least in ((2, 1), (4, 4), (7, 32), (40, 10)):
        code = codewords(n, spec)
        pairs = [(code[i] != code[j]).sum() for i in range(n) for j in range(i)]
        assert min(pairs) >= least
        assert code.any(axis=0).all() and not code.all(axis=0).any()
    assert codewords(1, spec).shape == (1, 0)


def test_held_out_accuracy(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = train(docs.filter(~held_out()), LanguageSpec())
    tested = docs.filter(held_out())
    found = identify(tested, model).join(tested, "doc_id")
    right = found.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0]
    assert right > 0.98
    assert found.filter("score < 0 OR score > 1").count() == 0


def test_many_languages(spark):
    alphabets = {f"l{i:02d}": "".join(chr(97 + (i * 5 + k) % 26) for k in range(5)) for i in range(12)}
    rng = np.random.default_rng(1)
    text = lambda a: " ".join("".join(rng.choice(list(a), 4)) for _ in range(60))
    rows = [(k * 100 + i, text(a), lang) for k in range(6) for i, (lang, a) in enumerate(alphabets.items())]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = train(docs.filter("doc_id < 400"), LanguageSpec())
    found = identify(docs.filter("doc_id >= 400"), model).join(docs, "doc_id")
    assert found.filter("lang = lang_pred").count() == found.count() == 24


def test_unknown_and_nothing_learned(spark, edge, empty):
    learned = spark.createDataFrame([("hallo welt", "de"), ("hello world", "en")], "text string, lang string")
    model = train(learned, LanguageSpec())
    found = {r.doc_id: r for r in identify(edge, model).filter("doc_id is not null").collect()}
    assert all(found[i].lang_pred == "und" and found[i].score == 0 for i in (4, 5, 6))
    assert found[1].lang_pred in ("de", "en") and found[12].lang_pred in ("de", "en")
    assert identify(empty, model).count() == 0
    nothing = train(learned.limit(0), LanguageSpec())
    assert {r.lang_pred for r in identify(edge, nothing).collect()} == {"und"}
    one = train(learned.limit(1), LanguageSpec())
    assert {r.lang_pred for r in identify(edge, one).collect()} == {"und", "de"}
