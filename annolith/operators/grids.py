"""Frame grids, windows over them, and bounded or seeded choices of frames."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions.scalar import half_even, window_key

TARGET_FPS, TEACHER_FPS, FUTURE_FPS, FUTURE_S = 2.0, 0.5, 3.0, 4.0
FUTURE_ITEMS, CONTACT_S, CONTACT_IMAGES, LEARNER_FPS = 12, 0.75, 24, 5.0


def int_range(first: Column, past: Column) -> Column:
    """first .. past - 1; empty if there is nothing between (``sequence`` would count down)."""
    return F.when(past > first, F.sequence(first.cast("int"), (past - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def anchors(steps: DataFrame, *, fps: float = TARGET_FPS, start: str = "start_s", end: str = "end_s", duration: str = "duration") -> DataFrame:
    """A row for each tick of the grid inside a step and the source: adds anchor_frame and anchor_s."""
    stop = F.least(end, duration)
    first = F.greatest(F.lit(0), F.ceil(F.col(start) * fps - 1e-9))
    ticks = F.filter(int_range(first, F.ceil(stop * fps - 1e-9)), lambda i: i / fps < stop)
    return steps.withColumn("anchor_frame", F.explode(ticks)).withColumn("anchor_s", F.bround(F.col("anchor_frame") / fps, 9))


def image_anchors(steps: DataFrame, *, items: int = FUTURE_ITEMS) -> DataFrame:
    """A row for each image of a step with its window of following images: future_end and the copies that fill it up."""
    rows = steps.withColumn("anchor_media", F.explode(int_range(F.col("start_i"), F.least(F.col("end_i") + 1, F.col("media_count")))))
    n = F.least(F.lit(items), F.col("media_count") - F.col("anchor_media"))
    return rows.withColumn("future_end", F.col("anchor_media") + n - 1).withColumn("padding", F.lit(items) - n)


def future_windows(anchored: DataFrame, *, seconds: float = FUTURE_S, step_id: str = "pos") -> DataFrame:
    """The clip that follows each anchor: bounds, its length, whether it is padded, and its key."""
    stop = F.least(F.col("duration"), F.col("anchor_s") + seconds)
    out = anchored.withColumn("future_start_s", F.bround("anchor_s", 6)).withColumn("future_end_s", F.bround(stop, 6)).withColumn("future_s", F.bround(stop - F.col("anchor_s"), 6))
    out = out.withColumn("padded", stop - F.col("anchor_s") < seconds)
    return out.withColumn("window_key", window_key(F.col(step_id), F.col("anchor_frame"), F.lit(None).cast("int")))


def pending(windows: DataFrame, done: DataFrame, *, uid: str = "uid") -> DataFrame:
    """Windows not yet recorded: the anti-join comes before any decoding."""
    return windows.join(done.select(uid, "window_key").distinct(), [uid, "window_key"], "left_anti")


def every_nth(frames: DataFrame, n: int, *, index: str = "frame") -> DataFrame:
    return frames.where(F.col(index) % n == 0)


def sampled_frames(episodes: DataFrame, *, interval: int = 4, fps: float = TARGET_FPS, teacher: float = TEACHER_FPS) -> DataFrame:
    """The grid of each episode (uid, duration, source_fps, source_frames), every ``interval``-th tick of it.

    sampled_frame and its time, the source frame it comes from, and the teacher's frame that shows it.
    """
    ticks = (F.greatest(F.lit(1), F.floor(F.col("duration") * teacher + 0.5)) * int(fps / teacher)).cast("int")
    rows = episodes.withColumn("sampled_count", ticks).withColumn("sampled_frame", F.explode(F.sequence(F.lit(0), F.col("sampled_count") - 1, F.lit(interval))))
    at = F.col("sampled_frame") / fps
    source = F.least(F.col("source_frames") - 1, half_even(at * F.col("source_fps"))).cast("int")
    return rows.withColumn("sampled_s", at).withColumn("source_frame", source).withColumn("teacher_frame", half_even(at * teacher).cast("int"))


def following(rows: DataFrame, *, key: str, order: list[str], items: int = FUTURE_ITEMS, value: str) -> DataFrame:
    """For each row the values of itself and what follows, at most ``items``, and how many copies fill it up."""
    ahead = W.partitionBy(key).orderBy(*order).rowsBetween(W.currentRow, items - 1)
    out = rows.withColumn("window", F.collect_list(value).over(ahead))
    return out.withColumn("padding", F.lit(items) - F.size("window")).withColumn("filled", F.concat("window", F.array_repeat(F.element_at("window", -1), F.col("padding"))))


def contact_candidates(events: DataFrame, *, seconds: float = CONTACT_S, maximum: int = CONTACT_IMAGES) -> DataFrame:
    """Frames around a proposed contact (t, fps, frame_count, boundaries: starts of steps in seconds).

    The proposed frame and both sides of every boundary inside come first; the rest is spread evenly.
    """
    fps, n = F.col("fps"), F.col("frame_count")
    at = F.least(F.greatest(F.lit(0.0), F.col("t")), (n - 1) / fps)
    first = F.greatest(F.lit(0), F.floor((at - seconds) * fps)).cast("int")
    last = F.least(n - 1, F.ceil((at + seconds) * fps)).cast("int")
    inside = F.filter("boundaries", lambda b: (b >= F.col("first") / fps) & (b <= F.col("last") / fps))
    edges = F.flatten(F.transform(inside, lambda b: F.array((half_even(b * fps) - 1).cast("int"), half_even(b * fps).cast("int"))))
    rows = events.withColumn("first", first).withColumn("last", last).withColumn("important", F.concat(F.array(half_even(at * fps).cast("int")), edges))
    return rows.withColumn("candidates", bounded(F.col("first"), F.col("last"), F.col("important"), maximum))


def bounded(first: Column, last: Column, important: Column, maximum: int) -> Column:
    """At most ``maximum`` frames of first..last, sorted: all if they fit, else the important ones and evenly spaced ones.

    Ties of the spacing go to the even frame; where spaced frames fall together, frames from the low end fill up.
    Important frames alone are cut to the maximum, the lowest first.
    """
    none = F.array().cast("array<int>")
    inside = F.filter(F.transform(F.coalesce(important, none), lambda x: x.cast("int")), lambda x: x.between(first, last))

    def from_own(own: Column) -> Column:
        room = F.lit(maximum) - F.size(own)
        step = (last - first) / F.nullif(room - 1, F.lit(0))
        spread = F.transform(int_range(F.lit(0), room), lambda k: F.when(k == 0, first).when(k == room - 1, last).otherwise(F.bround(k * step + first)).cast("int"))
        return F.when(room <= 0, F.slice(own, 1, maximum)).otherwise(_once(F.array_union(own, spread), filled))

    def filled(both: Column) -> Column:
        low = F.array_except(int_range(first, F.least(last, first + 2 * maximum) + 1), both)
        more = F.slice(low, F.lit(1), F.greatest(F.lit(0), F.lit(maximum) - F.size(both)))
        return F.slice(F.array_sort(F.concat(both, more)), 1, maximum)

    some = _once(F.array_sort(F.array_distinct(inside)), from_own)
    return F.when(first.isNull() | last.isNull() | (last < first), none).when(last - first < maximum, int_range(first, last + 1)).otherwise(some)


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def fallback_frames(frame_count: Column, maximum: int = 12) -> Column:
    """Up to ``maximum`` evenly spaced frames, cut to whole numbers, each once."""
    spread = F.transform(F.sequence(F.lit(0), F.lit(maximum - 1)), lambda k: F.floor(k * (frame_count - 1) / (maximum - 1)).cast("int"))
    return F.when(frame_count <= 0, F.array().cast("array<int>")).when(frame_count <= maximum, int_range(F.lit(0), frame_count)).otherwise(F.array_distinct(spread))


def history_lattice(start: Column, query: Column, fps: Column, rate: float = LEARNER_FPS) -> Column:
    """Frames back from the query at ``rate`` a second, oldest first; null for a bad interval or a slower source."""
    n = F.floor((query - start) * rate / fps).cast("int")
    ok = (start >= 0) & (query >= start) & (fps >= rate)
    return F.when(ok, F.transform(F.sequence(n, F.lit(0), F.when(n > 0, F.lit(-1)).otherwise(F.lit(1))), lambda k: (query - half_even(k * fps / rate)).cast("int")))


def media_slice(items: Column, start: Column, end: Column) -> Column:
    """Items start..end, both inclusive, from zero."""
    return F.when(end >= start, F.slice(items, start + 1, end - start + 1)).otherwise(F.slice(items, F.lit(1), F.lit(0)))


def nearest_frame(t: Column, fps: Column, frame_count: Column) -> Column:
    return F.greatest(F.lit(0), F.least(frame_count - 1, half_even(t * fps))).cast("int")
