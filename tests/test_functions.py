import hashlib
import math
import random
import re
import unicodedata

import pytest
from pyspark.sql import functions as F

from opinara.functions import segment as S
from opinara.functions import stats
from opinara.functions import text as T
from opinara.functions.times import in_window, parse_mixed


def column(spark, values, make, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, t {kind}")
    return [r[0] for r in df.orderBy("i").select(make(F.col("t"))).collect()]


HARD = ["", "  \t ", "Hello", "soooo bad", "a​b", "x\n\n\n\ny  z\t\tq", "Bahut confuse hu, lu ya nahi SIZE ka issue hai", "नमस्ते दुनिया", "éte", "Delivery was late and the fabric felt cheap", "123 !!!", None]


def test_cap_runs_keeps_three(spark):
    assert column(spark, ["sooooooo bad", "soooo bad", "sooo bad", "aaa"], T.cap_runs) == ["sooo bad", "sooo bad", "sooo bad", "aaa"]


def test_normalise_matches_a_python_twin(spark):
    def twin(t):
        if t is None:
            return None
        t = unicodedata.normalize("NFC", t)
        t = re.sub("[​-‍⁠﻿\x00-\x08\x0b\x0c\x0e-\x1f]", "", t)
        t = re.sub(r"(.)\1{3,}", r"\1\1\1", t)
        return re.sub(r"\n{3,}", "\n\n", re.sub(r"[ \t]+", " ", t)).strip()

    assert column(spark, HARD, T.normalise) == [twin(t) for t in HARD]


def test_text_hash_ignores_case_and_punctuation(spark):
    a, b, c, d = column(spark, ["Good, app!", "good   app", "नमस्ते!", "नमस्ते"], T.text_hash)
    assert a == b == hashlib.sha1(b"good app").hexdigest() and c == d


def test_language_rule(spark):
    said = ["Bahut confuse hu, lu ya nahi SIZE ka issue hai", "Delivery was late and the fabric felt cheap", "नमस्ते", "123", "", "nahi"]
    assert column(spark, said, T.detect_language) == ["hinglish", "en", "hi", "other", "other", "hinglish"]


def test_emphasis(spark):
    flags = T.emphasis_flags(F.col("t"))
    df = spark.createDataFrame([("VERY bad!!",), ("sooo",), ("Fine.",)], "t string").select(*[c.alias(n) for n, c in flags.items()])
    assert [tuple(r) for r in df.collect()] == [(True, False, True), (False, True, False), (False, False, False)]


def python_spans(text):
    pieces = [m for m in re.findall(r".*?(?:[.!?\n]+(?=\s|\Z)|\Z)", text, re.S) if m]
    if not text.strip():
        return []
    if len(text.split()) < S.WHOLE_BELOW:
        return [(0, len(text))]
    joins = re.compile(r"^(and|but|so|because|also|then|however|though|although|which|that|plus|aur|lekin|par|phir|kyunki|isliye|matlab)\b", re.I)
    pronoun = re.compile(r"^(it|they|this|that|these|those|he|she|we|ye|yeh|woh|iska|uska)\b", re.I)
    out, at = [], 0
    for p in pieces:
        bare, n = p.lstrip(), len(p)
        if out and (joins.match(bare) or pronoun.match(bare) and len(text[out[-1][0] : out[-1][1]].split()) < S.GLUE_BELOW):
            out[-1] = (out[-1][0], at + n)
        else:
            out.append((at, at + n))
        at += n
    return [(a, b) for a, b in out if text[a:b].strip()]


def test_segmentation_matches_a_python_twin(spark):
    texts = [
        "The kurta was nice to wear at home. But it ran two sizes small. The refund took three weeks to arrive!",
        "Short one.", "", "   ", "One two three four five six seven eight nine. It broke! 😀 Then nothing happened?\nNew line here.", "a.b.c d... e f g h i j k l m n!?",
    ]
    got = column(spark, texts, lambda c: S.utterances(c))
    assert [[(x["s"], x["e"]) for x in row] for row in got] == [python_spans(t) for t in texts]


def test_segmentation_of_random_texts(spark):
    rng, bits = random.Random(4), ["a", "word", "it", "They", "that", "and", "But", "so", "item", "andy", ".", "!", "?", "...", "\n", "\n\n", "\n \n", "\t", "é", "😀", "\x01", "\x02", "\xa0", ".\n. "]
    texts = ["".join(rng.choice(bits) + rng.choice(["", " ", " ", " "]) for _ in range(rng.randrange(160))) for _ in range(600)]
    # long utterances, so that pronouns are judged by the words before them
    texts += [" ".join(rng.choice(["word", "word", "end.", "It", "end. It", "stop! But", "stop. And this"]) for _ in range(rng.randrange(400))) for _ in range(400)]
    got = column(spark, texts, lambda c: S.utterances(c))
    for text, row in zip(texts, got, strict=True):
        assert [(x["s"], x["e"]) for x in row] == python_spans(text)
        assert [x["said"] for x in row] == [text[x["s"] : x["e"]] for x in row]


def test_three_sentences_are_two_utterances_and_lose_nothing(spark):
    text = "The kurta was nice to wear at home. But it ran two sizes small. The refund took three weeks."
    df = spark.createDataFrame([("play", "1", text), ("play", "2", "")], "source string, source_id string, normalised_text string")
    rows = S.segment(df).orderBy("source_id", "span.start").collect()
    assert [r["source_id"] for r in rows] == ["1", "1", "2"] and (rows[2]["span"]["start"], rows[2]["span"]["end"]) == (0, 0)
    assert "".join(text[r["span"]["start"] : r["span"]["end"]] for r in rows[:2]) == text
    assert S.span_faults(S.segment(df)).first()["n_bad"] == 0


def test_wilson_and_tests(spark):
    df = spark.createDataFrame([(24, 24), (68, 135), (0, 0)], "x int, n int")
    low, high = stats.wilson(F.col("x"), F.col("n"))
    a, b, c = df.select(low, high).collect()
    assert a[0] == pytest.approx(0.8620237953, abs=1e-9) and a[1] == 1.0
    assert tuple(b) == pytest.approx((0.4204350169, 0.5867674427), abs=1e-9) and c[0] is None
    got = spark.range(1).select(*[stats.erfc(F.lit(x)) for x in (0.0, 0.5, 1.5, 3.0)]).first()
    assert list(got) == pytest.approx([math.erfc(x) for x in (0.0, 0.5, 1.5, 3.0)], rel=2e-7)
    z, p = stats.two_proportion_z(F.lit(5), F.lit(5), F.lit(7), F.lit(7))
    assert tuple(spark.range(1).select(z, p).first()) == (None, None)


def test_times(spark):
    said = ["2026-01-02T03:04:05Z", "2026-01-02T08:34:05+05:30", "2026-01-02 03:04:05", "soon", None]
    got = column(spark, said, lambda c: parse_mixed(c).cast("string"))
    assert got == ["2026-01-02 03:04:05"] * 3 + [None, None]
    kept = spark.range(1).select(in_window(F.lit(None).cast("timestamp"), F.lit("2026-01-10").cast("timestamp"), 3), in_window(F.lit("2026-01-01").cast("timestamp"), F.lit("2026-01-10").cast("timestamp"), 3)).first()
    assert tuple(kept) == (True, False)


def test_composed_text(spark):
    df = spark.createDataFrame([("Title", "<b>Body</b> &amp; more."), (None, "x"), ("", "")], "a string, b string")
    assert [r[0] for r in df.select(T.compose_text(F.col("a"), F.col("b"))).collect()] == ["Title. Body & more", "x", ""]


def test_counts_up_to_a_number_are_those_of_whole_texts(spark):
    rng, bits = random.Random(8), ["the", "kurta", "is", "hair", "hai", "it's", ".", "é", "\n", "\xa0", "  "]
    texts = [" ".join(rng.choice(bits) for _ in range(rng.randrange(30))) for _ in range(300)] + ["the " * n + "kurta " * k + "x" * m for n in (0, 248, 249, 250, 251) for k in (0, 2, 3, 15) for m in (0, 5, 900)] + [None]
    df = spark.createDataFrame([(x,) for x in texts], "t string")
    t = F.col("t")
    whole = [F.size(T.content_tokens(t)) >= 3, F.size(T.content_tokens(t)) >= 15, T.word_count(t) >= 10]
    short = [T.has_content_tokens(t, 3), T.has_content_tokens(t, 15), T.has_words(t, 10)]
    assert df.where(~F.array(*whole).eqNullSafe(F.array(*short)) & t.isNotNull()).count() == 0
