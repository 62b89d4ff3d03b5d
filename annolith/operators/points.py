"""Contact points: unpivot and pivot of pairs, review joins, the pair gate, questions and predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from annolith.functions.scalar import finite, two_decimal

SIDES = ("left", "right", "unknown")


def _xy_ok(xy: Column, top: float = 1000) -> Column:
    return F.coalesce((F.size(xy) == 2) & F.forall(xy, lambda v: finite(v) & v.between(0, top)), F.lit(False))


def point_rows(pairs: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Pairs (pair_index, h_xy, o_xy) to a row for each point: point_id, role, xy, and error for a bad or repeated one."""
    both = F.array(*[F.struct(F.concat(F.lit(p), F.col("pair_index")).alias("point_id"), F.lit(r).alias("role"), F.col(c).alias("xy")) for p, r, c in (("H", "contact_agent", "h_xy"), ("O", "contacted_object", "o_xy"))])
    rows = pairs.select(*keys, "pair_index", F.inline(F.filter(both, lambda p: p["xy"].isNotNull())))
    same = F.count("*").over(W.partitionBy(*keys, "point_id"))
    return rows.withColumn("error", F.when(same > 1, "duplicate_point").when(~_xy_ok(F.col("xy")), "invalid_point"))


def pair_rows(points: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Points back to pairs."""
    pick = lambda r: F.max(F.when(F.col("role") == r, F.col("xy")))
    return points.groupBy(*keys, "pair_index").agg(pick("contact_agent").alias("h_xy"), pick("contacted_object").alias("o_xy"))


def normalised_pairs(pairs: DataFrame, *, hand: tuple[str, ...] = ("h_xy_1000", "H_i", "hand_point", "agent_point"), thing: tuple[str, ...] = ("o_xy_1000", "O_i", "object_point")) -> DataFrame:
    """The first alias that is there, rounded half-even and clamped to the grid; error unless both are pairs of numbers."""
    have = lambda names: F.coalesce(*[F.col(n) for n in names if n in pairs.columns])
    clamp = lambda xy: F.transform(xy, lambda v: F.least(F.lit(1000), F.greatest(F.lit(0), F.bround(v))).cast("int"))
    out = pairs.withColumn("h_xy", clamp(have(hand))).withColumn("o_xy", clamp(have(thing)))
    ok = F.coalesce((F.size("h_xy") == 2) & (F.size("o_xy") == 2), F.lit(False))
    return out.withColumn("error", F.when(~ok, "invalid_pair"))


def decoded_detections(frames: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Detections (detection, width, height, points: array of h_point and o_point pixels) to numbered pairs on the grid."""
    from annolith.functions.scalar import pixel_to_grid

    rows = frames.select(*keys, "detection", "width", "height", F.posexplode("points").alias("_p", "_pair"))
    size = (F.col("width"), F.col("height"))
    grid = lambda f: F.array(*[pixel_to_grid(F.get(F.col(f"_pair.{f}"), F.lit(k)), s) for k, s in enumerate(size)])
    inside = lambda f: F.coalesce((F.size(f"_pair.{f}") == 2) & F.get(f"_pair.{f}", F.lit(0)).between(0, size[0] - 1) & F.get(f"_pair.{f}", F.lit(1)).between(0, size[1] - 1), F.lit(False))
    n = F.row_number().over(W.partitionBy(*keys).orderBy("detection", "_p")) - 1
    return rows.select(*keys, n.alias("pair_index"), "detection", grid("h_point").alias("h_xy"), grid("o_point").alias("o_xy"), F.when(~(inside("h_point") & inside("o_point")), "invalid_coordinate").alias("error"))


def visibility_reasons(pairs: DataFrame) -> DataFrame:
    """Adds reasons why a tracked pair cannot be used: hand_visible, hand_xy, object_visible, object_xy."""
    found = []
    for role, p in (("hand", "H"), ("object", "O")):
        xy = F.col(f"{role}_xy")
        missing = F.coalesce(F.size(xy) != 2, F.lit(True))
        found += [
            F.when(~F.col(f"{role}_visible").eqNullSafe(F.lit(True)), F.lit(f"{p}_tracker_invisible_or_missing")),
            F.when(missing, F.lit(f"{p}_coordinate_missing")).when(~_xy_ok(xy, 1), F.lit(f"{p}_coordinate_out_of_bounds")),
        ]
    return pairs.withColumn("reasons", F.array_compact(F.array(*found)))


def verdicts(points: DataFrame, reviews: DataFrame, criteria: tuple[str, ...], *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Each point with its review: accepted if every criterion says Yes; error unless there is exactly one whole review."""
    yes = [F.col(c) == "Yes" for c in criteria]
    whole = [F.col(c).isin("Yes", "No") for c in criteria]
    accepted, complete = yes[0], whole[0]
    for a, w in zip(yes[1:], whole[1:], strict=True):
        accepted, complete = accepted & a, complete & w
    one = reviews.groupBy(*keys, "point_id").agg(F.count("*").alias("_n"), F.bool_and(F.coalesce(accepted, F.lit(False))).alias("accepted"), F.bool_and(F.coalesce(complete, F.lit(False)) & (F.coalesce(F.trim("reason"), F.lit("")) != "")).alias("_whole"))
    both = points.withColumn("_in", F.lit(True)).join(one, [*keys, "point_id"], "full_outer")
    error = F.when(F.col("_in").isNull(), "unknown_point").when(F.col("_n").isNull(), "unreviewed_point").when(F.col("_n") > 1, "duplicate_review").when(~F.col("_whole"), "incomplete_review")
    return both.withColumn("error", error).drop("_in", "_n", "_whole")


def reviewed_pairs(pairs: DataFrame, decisions: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Pairs of which both points are there and were accepted."""
    good = decisions.where("accepted").select(*keys, "point_id").distinct()
    out = pairs.where(F.col("h_xy").isNotNull() & F.col("o_xy").isNotNull())
    for p in ("H", "O"):
        of = good.where(F.col("point_id").startswith(p)).select(*keys, F.substring("point_id", 2, 12).cast("int").alias("pair_index"))
        out = out.join(of, [*keys, "pair_index"], "left_semi")
    return out


def contact_gate(pairs: DataFrame, decisions: DataFrame, labels: DataFrame | None = None, *, keys: tuple[str, ...] = ("uid", "event_id"), require_side: bool = False) -> DataFrame:
    """Adds reasons for which a pair is removed at contact, and conflicting; a pair without reasons stays.

    A point with several decisions passes if all of them accept it; conflicting says that they differ.  Decisions and
    hand sides become one row for each pair before the one join.  Computed from the unfiltered pairs, so running it
    again changes nothing.
    """
    none = F.lit(None)
    said = decisions.select(*keys, "point_id", "accepted", none.cast("string").alias("side"))
    if labels is not None:
        said = said.unionByName(labels.select(*keys, "point_id", none.cast("boolean").alias("accepted"), F.col("hand_side").alias("side")))
    said = said.withColumn("pair_index", F.substring("point_id", 2, 12).cast("int")).withColumn("_p", F.substring("point_id", 1, 1))
    of = lambda p, c: F.when(F.col("_p") == p, F.col(c))
    one = said.groupBy(*keys, "pair_index").agg(
        *[f(of(p, "accepted")).alias(f"_{name}{p}") for p in ("H", "O") for name, f in (("all", F.bool_and), ("any", F.bool_or))], F.min(of("H", "side")).alias("_side"), F.count_distinct(of("H", "side")).alias("_sides")
    )
    out = pairs.join(one, [*keys, "pair_index"], "left")
    found = []
    for p, c in (("H", "h_xy"), ("O", "o_xy")):
        found += [F.when(F.col(c).isNull(), F.lit(f"{p}_missing_or_rejected_at_contact")), F.when(F.col(f"_all{p}").eqNullSafe(F.lit(False)), F.lit(f"{p}_contact_review_failed"))]
    if require_side:
        sure = F.coalesce((F.col("_sides") == 1) & F.col("_side").isin("left", "right"), F.lit(False))
        found.append(F.when(~sure, F.lit("H_handedness_unknown_or_missing")))
    differ = [F.coalesce(c, F.lit(False)) for c in (F.col("_allH") != F.col("_anyH"), F.col("_allO") != F.col("_anyO"), F.col("_sides") > 1)]
    return out.withColumn("reasons", F.array_compact(F.array(*found))).withColumn("conflicting", differ[0] | differ[1] | differ[2]).drop("_allH", "_anyH", "_allO", "_anyO", "_side", "_sides")


def observation_gate(points: DataFrame, gated: DataFrame, tracks: DataFrame, checks: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id"), frame: str = "query_frame") -> DataFrame:
    """For each tracked pair of an observation the reasons to drop both its points.

    points: role and pair_index of validated points; gated: from ``contact_gate``; tracks: hand_visible and
    object_visible; checks: hand_ok, object_ok, distance_ok (null: not checked) and more_reasons.
    """
    at = [*keys, frame, "pair_index"]
    roles = points.groupBy(*at).agg(F.collect_set("role").alias("_roles"))
    kept = gated.where(F.size("reasons") == 0).select(*keys, "pair_index", F.lit(True).alias("_kept"))
    rows = roles.join(tracks.select(*at, "hand_visible", "object_visible"), at, "full_outer").join(checks, at, "left").join(kept, [*keys, "pair_index"], "left")
    whole = F.coalesce(F.size("_roles") == 2, F.lit(False)) & F.array_contains("_roles", "hand") & F.array_contains("_roles", "object")
    found = [
        F.when(F.col("_kept").isNull(), F.lit("contact_pair_rejected")),
        F.when(~F.coalesce(whole, F.lit(False)), F.lit("H_or_O_missing_or_rejected_at_observation")),
        F.when(~F.col("hand_visible").eqNullSafe(F.lit(True)), F.lit("H_tracker_invisible_or_missing")),
        F.when(~F.col("object_visible").eqNullSafe(F.lit(True)), F.lit("O_tracker_invisible_or_missing")),
    ]
    after = [F.when(F.col("hand_ok").eqNullSafe(F.lit(False)), F.lit("H_observation_review_failed")), F.when(F.col("object_ok").eqNullSafe(F.lit(False)), F.lit("O_observation_review_failed")), F.when(F.col("distance_ok").eqNullSafe(F.lit(False)), F.lit("pair_distance_review_failed"))]
    extra = F.coalesce(F.col("more_reasons"), F.array().cast("array<string>"))
    return rows.select(*at, F.array_distinct(F.concat(F.array_compact(F.array(*found)), extra, F.array_compact(F.array(*after)))).alias("reasons"))


def questions(observations: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id", "query_frame")) -> DataFrame:
    """Coordinate questions from object points (point_id, role, xy, raw_xy on the grid, contact_frame): the answer in two decimals.

    Observations without an object point give no row; error if the query does not precede the contact, or a
    reviewed coordinate differs from the tracked one.
    """
    same = F.forall(F.zip_with("xy", "raw_xy", lambda a, b: F.abs(a - b / 1000) <= 1e-12), lambda x: F.coalesce(x, F.lit(False)))
    rounded = F.transform("raw_xy", lambda v: two_decimal(v / 1000))
    text = F.concat(F.lit("["), F.array_join(F.transform(rounded, lambda v: F.format_string("%.2f", v)), ", "), F.lit("]"))
    rows = observations.where(F.col("role") == "object").withColumn("_e", F.when((F.col("query_frame") < 0) | (F.col("query_frame") >= F.col("contact_frame")), "query_not_before_contact").when(~same, "reviewed_differs_from_tracked"))
    made = rows.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("point_id", rounded.alias("xy"), text.alias("text")))).alias("_p"), F.max("_e").alias("error"))
    return made.select(*keys, F.size("_p").alias("object_points"), F.transform("_p", lambda p: p["xy"]).alias("answer"), F.concat(F.lit('{"object": ['), F.array_join(F.transform("_p", lambda p: p["text"]), ", "), F.lit("]}")).alias("answer_text"), "error")


def with_sides(points: DataFrame, labels: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id")) -> DataFrame:
    """Adds contact_hand_side: an object point takes that of its pair's hand; unknown if there is none."""
    hand = F.when(F.col("role") == "hand", F.col("point_id")).otherwise(F.concat(F.lit("H"), F.substring("point_id", 2, 12)))
    return points.withColumn("_h", hand).join(labels.select(*keys, F.col("point_id").alias("_h"), "hand_side"), [*keys, "_h"], "left").withColumn("contact_hand_side", F.coalesce("hand_side", F.lit("unknown"))).drop("_h", "hand_side")


def side_counts(points: DataFrame, *, keys: tuple[str, ...] = ("uid", "event_id", "query_frame")) -> DataFrame:
    hand = F.col("role") == "hand"
    return points.groupBy(*keys).agg(*[F.count_if(hand & (F.col("contact_hand_side") == s)).alias(f"{s}_hand") for s in SIDES], F.count_if(F.col("role") == "object").alias("object"))


def prediction_errors(predictions: DataFrame, expected: DataFrame, *, keys: tuple[str, ...] = ("uid",), two_places: bool = False) -> DataFrame:
    """For each role (keys, role, points: array of xy) whether count, range and precision are right."""
    both = predictions.join(expected.select(*keys, "role", "count"), [*keys, "role"], "full_outer")
    flat = F.flatten("points")
    error = F.when(F.col("count").isNull() | F.col("points").isNull(), "wrong_roles").when(F.size("points") != F.col("count"), "wrong_count").when(~F.forall("points", lambda p: _xy_ok(p, 1)), "invalid_coordinate")
    if two_places:
        error = error.when(F.exists(flat, lambda v: F.abs(v - two_decimal(v)) > 1e-9), "not_two_decimals")
    return both.withColumn("error", error)


def split_predictions(predictions: DataFrame, *, keys: tuple[str, ...] = ("uid",)) -> tuple[DataFrame, DataFrame]:
    """Predicted points that can be shown where they are, and those that cannot."""
    side = F.when(F.col("role").endswith("_hand"), F.regexp_replace("role", "_hand$", ""))
    rows = predictions.select(*keys, "role", F.posexplode("points").alias("_i", "xy")).withColumn("point_id", F.concat_ws("-", "role", (F.col("_i") + 1).cast("string")))
    rows = rows.withColumn("hand_side", side).withColumn("role", F.when(side.isNotNull(), "hand").otherwise(F.col("role"))).drop("_i")
    ok = _xy_ok(F.col("xy"), 1)
    return rows.where(ok), rows.where(~ok)


def nearest_pixel(pixels: DataFrame, *, keys: tuple[str, ...], x: Column, y: Column) -> DataFrame:
    """The mask pixel (px, py) nearest to a point; ties go to the first in reading order."""
    d = (F.col("px") - x) ** 2 + (F.col("py") - y) ** 2
    return pixels.groupBy(*keys).agg(F.min(F.struct(d.alias("d"), F.col("py"), F.col("px"))).alias("_m")).select(*keys, F.col("_m.px").alias("px"), F.col("_m.py").alias("py"), F.sqrt("_m.d").alias("distance"))


def nearest_mask(candidates: DataFrame, *, keys: tuple[str, ...]) -> DataFrame:
    """Of masks with their distance and score the nearest; then the best score, then the first."""
    best = F.struct(F.col("distance"), (-F.coalesce("score", F.lit(float("-inf")))).alias("s"), F.col("mask"))
    return candidates.groupBy(*keys).agg(F.min(best).alias("_m")).select(*keys, "_m.mask", "_m.distance", (-F.col("_m.s")).alias("score"))
