"""Reading targets as their pages land (F2, F3, F4 over a stream; an extension).

The batch flows see all pages of a target at once.  Here pages land in any order over many micro-batches, and keyed
state per target holds how far it has been read: the next page, the pager label before it, whether reading has ended,
and the reviews of pages that landed ahead of their turn.  A page's reviews are given out once all pages before it
have landed and none of them ended the target, so what is given out never has to be taken back, and in the end
it is what the batch flow reads.  A bad review (3.4) ends its target at its place, since rows that are out can't be
dropped with their target.  A page that lands again, or behind the end, is ignored.

State grows with the pages that wait for a page before them; an ended target keeps three numbers.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from revlens.operators import extract
from revlens.session import ship_package

REVIEW = ["pos", *extract.REVIEW_COLUMNS]
OUT = "target string, page_no int, pos int, date date, rating double, title string, body string, image string"
#: Next page, label of the page before, whether reading has ended, and {page: [label, [[stops, review], ...]]} in wait.
STATE = "next int, label string, ended boolean, waiting string"


def _pages(rows: pd.DataFrame) -> dict[int, list]:
    """{page: [label, [[stops, bad, pos, date, rating, title, body, image], ...]]} of a batch's rows."""
    found: dict[int, list] = {}
    rows = rows.sort_values(["page_no", "pos"])
    for r in rows.itertuples():
        page = found.setdefault(int(r.page_no), [None if pd.isna(r.page_label) else r.page_label, []])
        values = [None if pd.isna(v) else v for v in (r.rating, r.title, r.body, r.image)]
        page[1].append([bool(r.stop), bool(r.bad), int(r.pos), None if pd.isna(r.date) else str(r.date), *values])
    return found


def _advance(next_: int, label: str | None, waiting: dict[int, list]) -> tuple[int, str | None, bool, list]:
    """(next page, label, ended, rows given out) after reading on as far as pages are there."""
    out: list[list] = []
    while next_ in waiting:
        shown, reviews = waiting.pop(next_)
        page, next_ = next_, next_ + 1
        if page == 1 and shown is not None:
            shown = "1"
        if shown is not None and page > 1 and shown == label:
            continue                                    # the pager showed the same page again
        if shown == "1" and page > 1:
            return next_, label, True, out              # it came back to the first page
        label = shown if shown is not None else label
        for stop, bad, *review in reviews:
            if stop or bad:
                return next_, label, True, out
            out.append([page, *review])
    return next_, label, False, out


def _read(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    next_, label, ended, held = state.get if state.exists else (1, None, False, "{}")
    out: list[list] = []
    if not ended:
        waiting = {int(k): v for k, v in json.loads(held).items()}
        for rows in parts:
            for page, found in _pages(rows).items():
                if page >= next_:
                    had = waiting.setdefault(page, [found[0], []])
                    seen = {r[2] for r in had[1]}       # a page may come in several parts, or twice
                    had[1] = sorted(had[1] + [r for r in found[1] if r[2] not in seen], key=lambda r: r[2])
        next_, label, ended, out = _advance(next_, label, waiting)
        state.update((next_, label, ended, "{}" if ended else json.dumps(waiting)))
    if out:
        frame = pd.DataFrame(out, columns=["page_no", *REVIEW])
        frame.insert(0, "target", key[0])
        frame["date"] = pd.to_datetime(frame["date"]).dt.date
        yield frame


def reviews_as_they_land(pages: DataFrame, layout: str, earliest: Column | None = None) -> DataFrame:
    """Streaming JSON ``pages(target, page_no, payload[, page_label])`` -> the reviews that a target's reading gives, as
    ``OUT``, each once.  Pages are numbered 1, 2, ... by fetch."""
    ship_package(pages.sparkSession)
    rows = extract.page_reviews(pages, layout, earliest)
    stop = F.col("empty_page")
    if earliest is not None:
        stop = stop | F.coalesce(F.col("date") < earliest, F.lit(False))
    label = F.col("page_label").cast("string") if "page_label" in pages.columns else F.lit(None).cast("string")
    rows = rows.select("target", "page_no", label.alias("page_label"), stop.alias("stop"), "bad", *REVIEW)
    return rows.groupBy("target").applyInPandasWithState(_read, OUT, STATE, "append", GroupStateTimeout.NoTimeout)
