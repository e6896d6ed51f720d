"""Cutting a text into utterances with exact code-point spans.

A text is cut after runs of sentence ends before white space, so the pieces are the text again. A piece that begins with a
conjunction is glued to the one before, and so is one that begins with a pronoun while that one is short.

Three regular expressions put the cuts as marks into the text, so that pieces that are glued never come to be: one marks
the boundaries before which no conjunction follows; one tells which of these stand before a pronoun; and, only in texts
that have such, one walks from utterance to utterance and keeps of those marks the first behind words enough.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import trimmed

#: How a piece begins that goes on with the thought before.
CONTINUES = "and|but|so|because|also|then|however|though|although|which|that|plus|aur|lekin|par|phir|kyunki|isliye|matlab"
PRONOUN = "it|they|this|that|these|those|he|she|we|ye|yeh|woh|iska|uska"
#: Words of a text below which it is one utterance, and of a piece above which a pronoun begins a new one.
WHOLE_BELOW, GLUE_BELOW = 8, 25
#: Marks of a cut and of a cut that is still to be judged; normalised texts hold neither.
CUT, MAYBE = "\x01", "\x02"
#: White space before a piece's first word; a line end before more white space would end the piece.
LEAD = r"[^\S\n]*+\n?"


def cut_marks(text: Column, glue_below: int = GLUE_BELOW) -> Column:
    """The text, which holds no marks of its own, with a mark at each place where an utterance ends and another begins."""
    marked = F.regexp_replace(text, rf"(?iU)((?>[.!?\n]+(?=\s|\z)))(?!\z)(?!{LEAD}(?:{CONTINUES})\b)", f"$1{CUT}")
    judged = F.regexp_replace(marked, rf"(?iU){CUT}(?={LEAD}(?:{PRONOUN})\b)", MAYBE)
    # from the beginning of an utterance on: words enough, then all up to the next mark, which stays
    word = rf"[\s{MAYBE}]*+[^\s{CUT}{MAYBE}]++"
    enough = rf"(?U)(?:\G|(?<={CUT}))((?:{word}){{{glue_below}}}+[^{CUT}{MAYBE}]*+){MAYBE}"
    keep = lambda j: F.when(F.contains(j, F.lit(MAYBE)), F.replace(F.regexp_replace(j, enough, f"$1{CUT}"), F.lit(MAYBE), F.lit(""))).otherwise(j)
    return F.transform(F.array(judged), keep)[0]  # a lambda's variable is computed once


def utterances(text: Column, whole_below: int = WHOLE_BELOW, glue_below: int = GLUE_BELOW) -> Column:
    """``array<struct<s,e,said>>``: start, end and all characters of each utterance; blank ones are left out."""
    marked = F.contains(text, F.lit(CUT)) | F.contains(text, F.lit(MAYBE))  # by itself, as normalised texts are not
    own = F.when(marked, F.translate(text, CUT + MAYBE, "\x03\x03")).otherwise(text)
    pieces = F.when(text.rlike(rf"(?U)^\s*(?:\S+\s+){{{whole_below - 1}}}\S"), F.split(cut_marks(own, glue_below), CUT, -1)).otherwise(F.array(text))
    none = F.array().cast("array<struct<s:int,e:int,said:string>>")
    placed = F.aggregate(
        pieces,
        F.struct(F.lit(0).alias("at"), none.alias("out")),
        lambda a, x: F.struct((a["at"] + F.length(x)).alias("at"), F.concat(a["out"], F.array(F.struct(a["at"].alias("s"), (a["at"] + F.length(x)).alias("e"), x.alias("said")))).alias("out")),
        lambda a: F.filter(a["out"], lambda u: u["said"].rlike(r"(?U)\S")),
    )
    given = lambda u: F.struct(u["s"].alias("s"), u["e"].alias("e"), F.substring(text, u["s"] + 1, u["e"] - u["s"]).alias("said"))
    return F.when(marked, F.transform(placed, given)).otherwise(F.coalesce(placed, none))


def utterance_id(source: Column, source_id: Column, start: Column, end: Column) -> Column:
    return F.sha1(F.concat_ws("|", source, source_id, start.cast("string"), end.cast("string")))


def segment(df: DataFrame, text: str = "normalised_text", whole_below: int = WHOLE_BELOW) -> DataFrame:
    """A row for each utterance of ``df(source, source_id, text)``; a blank or null text is one empty utterance (0, 0)."""
    each = df.withColumn("_s", F.explode_outer(utterances(F.col(text), whole_below)))
    start, end = F.coalesce("_s.s", F.lit(0)), F.coalesce("_s.e", F.lit(0))
    said = F.coalesce(trimmed(F.col("_s.said")), F.lit(""))
    out = each.withColumns({"span": F.struct(start.alias("start"), end.alias("end")), "utterance_text": said, "reference_text": F.col(text)})
    return out.withColumn("utterance_id", utterance_id(F.col("source"), F.col("source_id").cast("string"), F.col("span.start"), F.col("span.end"))).drop("_s")


def span_faults(df: DataFrame) -> DataFrame:
    """``n_rows, n_bad, n_whole``: utterances, those whose span does not give their text, and texts left in one piece."""
    cutout = trimmed(F.substring(F.col("reference_text"), F.col("span.start") + 1, F.col("span.end") - F.col("span.start")))
    return df.agg(
        F.count("*").alias("n_rows"),
        F.count_if(~F.col("utterance_text").eqNullSafe(F.coalesce(cutout, F.lit("")))).alias("n_bad"),
        F.count_if((F.col("span.start") == 0) & (F.col("span.end") == F.length("reference_text"))).alias("n_whole"),
    )
