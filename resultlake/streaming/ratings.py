"""Ratings with one state for each entity, over a batch in date order or over a stream.

All games of a date count at once, from the state at the date's start. What an entity
carries is its rating and its form, the mean of its scores before the date drawn to one
half by ``PRIOR`` games; the other side of a game counts by its form alone, so each state
depends on nothing but its entity's games. The rating of a form is the one whose expected
score against an average entity is that form.

In a batch the forms are a running sum over an entity's dates, joined to the games of the
other side, and ratings are folded in date order. Both are dealt by entity and sorted by
date, so a task holds one date of one entity. In a stream two queries follow each other:
the first keeps forms and adds to each game what the other side's form was, the second
keeps ratings. No step goes through dates on the driver.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

#: Rating of a new entity, weight of a game, games of one half that a form begins with.
INIT, K, PRIOR = 1500.0, 20.0, 10.0
#: Rows that a task of a batch folds at once, about; a date of one entity may be longer.
STRETCH = 1 << 17
RATED = "date {date}, entity string, n_games long, before double, after double"


def sides(games: DataFrame) -> DataFrame:
    """``games`` (date, game_id, a, b, score of a in 0 to 1) as a row for each side; games without a side, score or date go.

    A date is a date, or anything whose order is that of its text.
    """
    one = lambda a, b, score: F.struct(F.col(a).cast("string").alias("entity"), F.col(b).cast("string").alias("other"), score.cast("double").alias("score"))
    both = F.array(one("a", "b", F.col("score")), one("b", "a", 1 - F.col("score")))
    rows = games.dropna(subset=["date", "a", "b", "score"]).select("date", F.col("game_id").cast("string").alias("game_id"), F.explode(both).alias("s"))
    return rows.select("date", "game_id", "s.*")


def forms(rows: DataFrame, prior: float = PRIOR) -> DataFrame:
    """(entity, date, form): the form before each date that an entity plays on."""
    day = rows.groupBy("entity", "date").agg(F.sum("score").alias("__s"), F.count("*").alias("__n"))
    before = Window.partitionBy("entity").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    total = lambda c: F.coalesce(F.sum(c).over(before), F.lit(0))
    return day.select("entity", "date", ((total("__s") + prior / 2) / (total("__n") + prior)).alias("form"))


def strength(form, init: float = INIT):  # noqa: ANN001, ANN201
    """The rating of a form; for numbers and arrays."""
    return init + 400 * np.log10(form / (1 - form))


def _moved(rating: float, form: np.ndarray, score: np.ndarray, n: np.ndarray, k: float, init: float) -> float:
    """The rating after the games of a date: against sides of some forms, with the sum of scores and number of games."""
    expected = 1 / (1 + 10 ** ((strength(form, init) - rating) / 400))
    return rating + k * float((score - n * expected).sum())


def rate(games: DataFrame, k: float = K, init: float = INIT, prior: float = PRIOR) -> DataFrame:
    """(date, entity, n_games, before, after) for each date that an entity plays on.

    ``games`` (date, game_id, a, b, score): see :func:`sides`; equal rows are games each.
    Games against sides of one form are added up before they move. An entity with very many
    games is a task's, a date at a time; an empty table gives an empty result.
    """
    rows = sides(games)
    met = forms(rows, prior).withColumnRenamed("entity", "other")
    faced = rows.join(met, ["other", "date"]).groupBy("entity", "date", "form").agg(F.sum("score").alias("score"), F.count("*").alias("n"))
    dealt = faced.repartition("entity").sortWithinPartitions("entity", "date", "form").select("entity", "date", "form", "score", "n")

    def fold(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Entities of a stretch of rows move date by date, all at once; the last date and its entity's rating are carried on."""
        held: list[pa.RecordBatch] = []
        last, rating = None, init
        for b in it:
            held.append(b)
            if sum(x.num_rows for x in held) >= STRETCH:
                out, rest, last, rating = _folded(held, last, rating, False, k, init)
                held = [rest]
                yield out
        if sum(x.num_rows for x in held):
            yield _folded(held, last, rating, True, k, init)[0]

    return dealt.mapInArrow(fold, RATED.format(date=_kind(games)))


def _kind(games: DataFrame) -> str:
    return games.schema["date"].dataType.simpleString()


def _folded(held: list[pa.RecordBatch], last: str | None, rating: float, whole: bool, k: float, init: float) -> tuple[pa.RecordBatch, pa.RecordBatch, str | None, float]:
    """(ratings, rows of the last date, its entity, the rating before it) of rows (entity, date, form, score, n) in order.

    ``rating`` is that of the entity ``last``, which the rows may go on with. Of rows that
    are ``whole`` none is left over.
    """
    rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
    entity, date = rows.column("entity"), rows.column("date")
    other = lambda c: np.concatenate([[True], pc.not_equal(c[1:], c[:-1]).to_numpy(zero_copy_only=False)])
    fresh = other(entity)
    starts = np.flatnonzero(fresh | other(date))
    ends = np.append(starts[1:], len(rows))
    if not whole:
        left = rows.slice(starts[-1])
        starts, ends = starts[:-1], ends[:-1]
    form, score, n = (rows.column(c).to_numpy(zero_copy_only=False) for c in ("form", "score", "n"))
    met = strength(form, init)
    whose = np.cumsum(fresh[starts]) - 1 if len(starts) else starts  # the entity of each date
    now = np.full(whose[-1] + 1 if len(starts) else 0, init)
    if len(now) and entity[0].as_py() == last:
        now[0] = rating
    first = np.flatnonzero(np.diff(whose, prepend=-1))
    nth = np.arange(len(whose)) - first[whose]
    before, after = np.empty(len(starts)), np.empty(len(starts))
    order = np.argsort(nth, kind="stable")
    for some in np.split(order, np.cumsum(np.bincount(nth))[:-1]) if len(starts) else []:
        size = ends[some] - starts[some]
        begin = np.cumsum(size) - size
        at = np.repeat(starts[some] - begin, size) + np.arange(size.sum())
        before[some] = now[whose[some]]
        gained = score[at] - n[at] / (1 + 10 ** ((met[at] - np.repeat(before[some], size)) / 400))
        after[some] = now[whose[some]] = before[some] + k * np.add.reduceat(gained, begin)
    games = np.add.reduceat(n[: ends[-1]], starts) if len(starts) else np.zeros(0, np.int64)
    at = pa.array(starts)
    out = pa.RecordBatch.from_arrays([date.take(at), entity.take(at), pa.array(games), pa.array(before), pa.array(after)], ["date", "entity", "n_games", "before", "after"])
    if whole:
        return out, rows.slice(len(rows)), None, init
    own = left.column("entity")[0].as_py()
    if len(starts) and entity[int(starts[-1])].as_py() == own:
        rating = float(now[-1])
    elif own != last:
        rating = init
    return out, left, own, rating


def faced_stream(games: DataFrame, prior: float = PRIOR) -> DataFrame:
    """A stream of games as (date, game_id, entity, score, form): each side with the form of the other.

    State of a side: its games and scores before its newest date, and of that date. Dates
    come in order; a game older than its side's newest date would change forms that were
    already given, and is left out.
    """
    schema = f"date {_kind(games)}, game_id string, entity string, score double, form double"

    def each(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        n, total, newest, n_new, new = state.get if state.exists else (0, 0.0, None, 0, 0.0)
        rows = pd.concat(list(parts)).sort_values(["date", "game_id"])
        out = []
        for date, game, other, score in zip(rows["date"], rows["game_id"], rows["other"], rows["score"]):
            day = str(date)
            if newest is not None and day < newest:
                continue
            if day != newest:
                n, total, n_new, new, newest = n + n_new, total + new, 0, 0.0, day
            out.append((date, game, other, 1 - score, (total + prior / 2) / (n + prior)))
            n_new, new = n_new + 1, new + score
        state.update((n, total, newest, n_new, new))
        yield pd.DataFrame(out, columns=["date", "game_id", "entity", "score", "form"])

    kept = "n long, total double, newest string, n_new long, new double"
    return sides(games).groupBy("entity").applyInPandasWithState(each, schema, kept, "append", GroupStateTimeout.NoTimeout)


def rate_stream(faced: DataFrame, k: float = K, init: float = INIT) -> DataFrame:
    """A stream of :func:`faced_stream` as ratings (date, entity, n_games, before, after), a row again whenever a date gets more games.

    State of an entity: its newest date with the rating at its start, and what its games of
    that date have added. The last row of a date and entity, the one with the most games,
    counts. Games older than an entity's newest date are left out.
    """

    def each(key: tuple, parts: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        before, newest, n, moved = state.get if state.exists else (init, None, 0, 0.0)
        rows = pd.concat(list(parts))
        rows["day"] = rows["date"].astype(str)
        out = []
        for day, some in rows.groupby("day", sort=True):
            if newest is not None and day < newest:
                continue
            if day != newest:
                before, newest, n, moved = before + moved, day, 0, 0.0
            same = some.groupby("form", sort=True)["score"].agg(["sum", "count"]).reset_index()
            moved += _moved(before, same["form"].to_numpy(), same["sum"].to_numpy(), same["count"].to_numpy(), k, init) - before
            n += len(some)
            out.append((some["date"].iloc[0], key[0], n, before, before + moved))
        state.update((before, newest, n, moved))
        yield pd.DataFrame(out, columns=["date", "entity", "n_games", "before", "after"])

    kept = "before double, newest string, n long, moved double"
    return faced.groupBy("entity").applyInPandasWithState(each, RATED.format(date=_kind(faced)), kept, "append", GroupStateTimeout.NoTimeout)


def follow(games: DataFrame, folder: str, k: float = K, init: float = INIT, prior: float = PRIOR) -> DataFrame:
    """All that has arrived of a stream of games, rated: two queries to their end, and the table that they leave.

    ``folder`` holds the queries' checkpoints and results; a query that dies goes on where
    it was when this is called again.
    """
    spark = games.sparkSession

    def write(rows: DataFrame, name: str) -> StreamingQuery:
        out = rows.writeStream.format("parquet").option("path", f"{folder}/{name}").option("checkpointLocation", f"{folder}/{name}-checkpoint")
        return out.trigger(availableNow=True).outputMode("append").start()

    write(faced_stream(games, prior), "faced").awaitTermination()
    schema = spark.read.parquet(f"{folder}/faced").schema
    write(rate_stream(spark.readStream.schema(schema).parquet(f"{folder}/faced"), k, init), "rated").awaitTermination()
    rated = spark.read.parquet(f"{folder}/rated")
    last = F.max_by(F.struct("before", "after"), F.col("n_games")).alias("v")
    return rated.groupBy("date", "entity").agg(F.max("n_games").alias("n_games"), last).select("date", "entity", "n_games", "v.before", "v.after")
