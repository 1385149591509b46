"""Line deduplication by winnowing: runs of ``window`` or more lines that occurred before are deleted.

Lines are what newlines separate.  Of every ``window`` consecutive lines the least line hash is the fingerprint
(the last one of ties), so a shared run of that many lines shares a fingerprint at the same place.
Fingerprints that occur once are left out; around the others the windows of lines that hold them are compared
by a 128-bit digest of their text, and joined with the earliest occurrence (by id, then line).  A match extends
both ways through the neighbouring windows, as far as they have an earlier occurrence too; all lines of
windows that are not the earliest are deleted.

With ``words``, shorter runs count too once they hold that many words (runs of other than ASCII white space): a
window of 1 to ``window`` - 1 lines with ``words`` words or more is its own fingerprint and takes the same joins,
so a passage of one or two long lines, or a text of one or two lines, is deleted where it occurs again.

A null text counts as empty (one empty line); without ``words`` texts with fewer lines than ``window`` lose
nothing.  A row without an id keeps its text and is nobody's earlier occurrence; rows repeated with their id are one
occurrence and keep their text alike; an empty table gives an empty result.

Scale: fingerprints, digests and earliest places are aggregated with map-side combine; the joins are on
narrow rows, with a second key so that both sides are exchanged and adaptive execution can split hot lines.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from revlens.llm.common import id_text, scratch

WINDOW = 3
#: Words that make a run of fewer lines a passage.
PASSAGE = 50
WORD = r"[^\x20\t\n\x0B\f\r]+"


def fingerprints(lines: Column, window: int) -> Column:
    """Per window of lines: place, hash of its least line, digest of its text, and whether the window is the
    first that selects this line.  A window's lines are zipped beforehand (with the line before it), so no
    window looks into the whole text."""
    n = F.greatest(F.size(lines) - window + 1, F.lit(0))
    before = F.slice(F.concat(F.array(F.lit(None).cast("string")), lines), F.lit(1), n)
    zipped = F.arrays_zip(before.alias("l0"), *(F.slice(lines, F.lit(j), n).alias(f"l{j}") for j in range(1, window + 1)))

    def least_place(w: Column, first: int) -> tuple[Column, Column]:
        """(least hash, its last place counted from the window's own first line) of ``window`` lines."""
        hashes = [F.xxhash64(w[f"l{first + j}"]) for j in range(window)]
        least = F.least(*hashes)
        place = F.coalesce(*(F.when(hashes[j] == least, F.lit(first - 1 + j)) for j in reversed(range(window))))
        return least, place

    def one(w: Column, at: Column) -> Column:
        least, place = least_place(w, 1)
        digest = F.unhex(F.md5(F.concat_ws("\n", *(w[f"l{j}"] for j in range(1, window + 1)))))
        return F.struct(at.alias("at"), least.alias("print"), digest.alias("digest"),
                        ((at == 0) | (least_place(w, 0)[1] != place)).alias("first"))

    return F.transform(zipped, one)


def passages(lines: Column, height: int, words: int) -> Column:
    """Windows of ``height`` lines that hold ``words`` words or more, like ``fingerprints``; each is its own print."""
    n = F.greatest(F.size(lines) - height + 1, F.lit(0))
    zipped = F.arrays_zip(*(F.slice(lines, F.lit(j), n).alias(f"l{j}") for j in range(1, height + 1)))

    def one(w: Column, at: Column) -> Column:
        text = F.concat_ws("\n", *(w[f"l{j}"] for j in range(1, height + 1)))
        long = (F.length(text) >= 2 * words - 1) & (F.regexp_count(text, F.lit(WORD)) >= words)
        return F.when(long, F.struct(at.alias("at"), F.xxhash64(text).alias("print"), F.unhex(F.md5(text)).alias("digest"),
                                     F.lit(True).alias("first")))

    return F.filter(F.transform(zipped, one), lambda w: w.isNotNull())


def repeated_windows(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
                     words: int | None = None) -> DataFrame:
    """(doc_id, at, high) of the windows of lines that occurred before, ``high`` exclusive."""
    if window < 2:
        raise ValueError("a window has two lines at least")
    if words is not None and words < 1:
        raise ValueError("a passage has one word at least")
    rows = id_text(docs, id_col, text_col).where("doc_id IS NOT NULL")
    cut = rows.select("doc_id", F.split("text", "\n", -1).alias("lines"))

    def ending(windows: Column, height: int) -> Column:
        return F.transform(windows, lambda w: w.withField("high", w["at"] + height))

    windows = ending(fingerprints(F.col("lines"), window), window)
    if words is None:
        cut = cut.where(F.size("lines") >= window)
    else:
        windows = F.concat(windows, *(ending(passages(F.col("lines"), k, words), k) for k in range(1, window)))
    places = cut.select("doc_id", F.explode_outer(windows).alias("w")).select(
        "doc_id", "w.at", "w.high", "w.print", "w.digest", "w.first").where("at IS NOT NULL")
    places = scratch(places, "line-windows")
    # a window can only occur again where its fingerprint is selected again
    prints = places.where("first").groupBy("print").agg(F.count("*").alias("n")).where("n > 1").select("print")
    again = places.join(prints, "print", "left_semi")
    earliest = (again.groupBy("digest").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "at")).alias("was"))
                .where("n > 1").select("digest", "was"))
    later = again.drop("first").join(earliest, "digest").where(
        (F.col("doc_id") != F.col("was.doc_id")) | (F.col("at") != F.col("was.at")))
    return later.select("doc_id", "at", "high").distinct()


def _runs(windows: Column) -> Column:
    """Windows (at, high) -> sorted runs of lines (low, high), high exclusive."""
    kind = "array<struct<low:int,high:int>>"

    def join(runs: Column, w: Column) -> Column:
        last = F.try_element_at(runs, F.lit(-1))
        longer = F.array_append(F.slice(runs, F.lit(1), F.greatest(F.size(runs) - 1, F.lit(0))),
                                F.struct(last["low"].alias("low"), F.greatest(last["high"], w["high"]).alias("high")))
        new = F.array_append(runs, F.struct(w["at"].alias("low"), w["high"].alias("high")))
        return F.when(last.isNotNull() & (last["high"] >= w["at"]), longer).otherwise(new).cast(kind)

    return F.aggregate(F.array_sort(windows), F.array().cast(kind), join)


def line_dedup(docs: DataFrame, window: int = WINDOW, id_col: str = "doc_id", text_col: str = "text",
               words: int | None = None) -> DataFrame:
    """Per row: ``doc_id``, ``text`` (what is kept), ``n_lines``, ``n_removed``, ``n_runs``."""
    base = id_text(docs, id_col, text_col)
    gone = repeated_windows(docs, window, id_col, text_col, words).groupBy("doc_id").agg(
        F.collect_list(F.struct("at", "high")).alias("windows"))
    gone = gone.select("doc_id", _runs(F.col("windows")).alias("runs"))
    rows = base.join(gone, "doc_id", "left").withColumn("lines", F.split("text", "\n", -1))
    runs = F.col("runs")
    edges = F.concat(F.array(F.lit(0)), F.transform(runs, lambda r: r["high"]))
    ends = F.concat(F.transform(runs, lambda r: r["low"]), F.array(F.size("lines")))
    kept = F.flatten(F.transform(F.arrays_zip(edges.alias("low"), ends.alias("high")),
                                 lambda g: F.slice("lines", g["low"] + 1, g["high"] - g["low"])))
    removed = F.aggregate(runs, F.lit(0), lambda n, r: n + r["high"] - r["low"])
    return rows.select(
        "doc_id", F.when(runs.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n")).alias("text"),
        F.size("lines").cast("long").alias("n_lines"),
        F.coalesce(removed, F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.size(runs), F.lit(0)).cast("long").alias("n_runs"))
