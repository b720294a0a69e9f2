"""Catalogue work around a capture: profiles, queue state, hold-out, budgets, rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from waymark.functions.scalars import focal, frame_number, held_out
from waymark.operators.shared import with_place


def override(profiles: DataFrame, by: str = "name", order: str = "dir_order") -> DataFrame:
    """The profile of the latest folder for each name."""
    w = Window.partitionBy(by).orderBy(F.desc(order))
    return profiles.withColumn("_r", F.row_number().over(w)).where("_r = 1").drop("_r")


def detect_profiles(files: DataFrame, profiles: DataFrame) -> DataFrame:
    """files (path, tracks, width, height) with profile and score; null if none fits.

    A rule column that is null fits all: suffixes, tracks, sizes (strings like 4096x1344). The score is the
    priority, and 100 more for a size rule; of equals the first in load_order wins. Files and profiles meet by suffix, each
    profile once for every suffix it lists; those that list none are joined on the number of tracks, or all, if they name none. A
    registry of up to 100,000 rules is broadcast, so no suffix or number of tracks that most files have makes a hot partition.
    """
    f = files.withColumn("_suffix", F.lower(F.regexp_extract("path", r"(\.[^./]*)$", 1))).withColumn("_size", F.concat_ws("x", "width", "height"))
    p = profiles.select(F.col("name").alias("profile"), "priority", "suffixes", F.col("tracks").alias("_tracks"), "sizes", "load_order")
    listed = p.where("suffixes is not null").withColumn("_suffix", F.explode(F.array_distinct("suffixes")))
    every = p.where("suffixes is null")
    by_tracks, rest = every.where("_tracks is not null"), every.where("_tracks is null")
    sent = F.broadcast if profiles.limit(100_001).count() <= 100_000 else lambda df: df
    either = f.join(sent(listed), "_suffix").unionByName(f.join(sent(by_tracks), F.col("tracks") == F.col("_tracks"))).unionByName(f.withColumn("_any", F.lit(1)).join(sent(rest.withColumn("_any", F.lit(1))), "_any").drop("_any"))
    fits = (F.col("_tracks").isNull() | (F.col("_tracks") == F.col("tracks"))) & (F.col("sizes").isNull() | F.array_contains("sizes", F.col("_size")))
    score = F.col("priority") + F.when(F.col("sizes").isNotNull(), 100).otherwise(0)
    best = either.where(fits).groupBy("path").agg(F.min(F.struct((-score).alias("minus"), "load_order", "profile")).alias("_b"))
    return files.join(best.select("path", F.col("_b.profile").alias("profile"), (-F.col("_b.minus")).alias("score")), "path", "left")


def queue_status(events: DataFrame, now: object, lease_s: float = 3600.0, retries: int = 2) -> DataFrame:
    """(stage, item, attempts, state, stale) of queue events (stage, item, ts, kind: claim, heartbeat, done, failed).

    done outranks a held lock (running), then as many failures as retries (failed), then pending. A failure or done
    releases the lock. stale marks a held lock whose last claim or heartbeat is older than the lease: it counts
    as running until a worker takes it over.
    """
    held = F.max(F.when(F.col("kind").isin("claim", "heartbeat"), F.col("ts")))
    freed = F.max(F.when(F.col("kind").isin("done", "failed"), F.col("ts")))
    out = events.groupBy("stage", "item").agg(F.count_if(F.col("kind") == "done").alias("_done"), F.count_if(F.col("kind") == "failed").alias("attempts"), held.alias("_held"), freed.alias("_freed"))
    age = F.lit(now).cast("timestamp").cast("double") - F.col("_held").cast("timestamp").cast("double")
    running = F.col("_held").isNotNull() & (F.col("_freed").isNull() | (F.col("_held") > F.col("_freed")))
    state = F.when(F.col("_done") > 0, "done").when(running, "running").when(F.col("attempts") >= retries, "failed").otherwise("pending")
    return out.select("stage", "item", "attempts", state.alias("state"), ((state == "running") & (age >= lease_s)).alias("stale"))


def status_counts(status: DataFrame) -> DataFrame:
    return status.groupBy("stage").agg(*[F.count_if(F.col("state") == s).alias(s) for s in ("done", "running", "failed", "pending")])


def holdout(images: DataFrame, every: int) -> DataFrame:
    """Names (variant, name) kept for evaluation; an image without digits goes by its place among its variant's names.

    Places are only worked out if some name has no digits, and then without sorting a variant in one task.
    """
    number = frame_number(F.col("name"))
    if not images.where(number.isNull()).take(1):
        return images.where(held_out(F.col("name"), F.lit(0), every)).select("variant", "name")
    placed = with_place(images.select("variant", "name"), "variant", "name")
    starts = placed.groupBy("variant").agg(F.min("place").alias("_first"))
    return placed.join(starts, "variant").where(held_out(F.col("name"), F.col("place") - F.col("_first"), every)).select("variant", "name")


def common_holdout(images: DataFrame, every: int) -> DataFrame:
    """Names held out in every variant."""
    total = images.select("variant").distinct().agg(F.count("*").alias("_n"))
    held = holdout(images, every).distinct().groupBy("name").agg(F.count("*").alias("_v"))
    return held.join(F.broadcast(total), F.col("_v") == F.col("_n")).select("name")


def rank_sequences(images: DataFrame, min_images: int = 50, max_images: int | None = None) -> DataFrame:
    """Panoramas (sequence, id, captured_at, url, geometry ok) of long enough sequences, the longest first, in time order; max_images in all."""
    pano = images.where("is_pano")
    size = pano.groupBy("sequence").agg(F.count("*").alias("size")).where(F.col("size") >= min_images)
    kept = pano.join(size, "sequence").where("url is not null and lon is not null")
    if max_images is None:
        return kept
    # The first rows of a total order: Spark keeps max_images a task and merges them.
    return kept.orderBy(F.desc("size"), "sequence", "captured_at", "id").limit(max_images)


def capture_budget(probes: DataFrame, cards_gb: tuple[int, ...] = (64, 128, 512, 1024), mph: float = 15.0) -> DataFrame:
    """(path, card_gb, mbps, gb_per_min, minutes, miles) of (path, bytes, seconds) for each card."""
    mbps = F.col("bytes") * 8 / F.col("seconds") / 1e6
    gb = F.col("bytes") / 1e9 / (F.col("seconds") / 60)
    out = probes.where("seconds > 0").withColumn("card_gb", F.explode(F.array(*[F.lit(c) for c in cards_gb])))
    return out.select("path", "card_gb", mbps.alias("mbps"), gb.alias("gb_per_min"), (F.col("card_gb") / gb).alias("minutes"), (F.col("card_gb") / gb / 60 * mph).alias("miles"))


def virtual_cameras(views: DataFrame) -> DataFrame:
    """Pinhole intrinsics of views (cam, width, height, fov)."""
    f = focal(F.col("width"), F.col("fov"))
    return views.select("*", f.alias("fx"), f.alias("fy"), (F.col("width") / 2).alias("cx"), (F.col("height") / 2).alias("cy"))


def missing(names: DataFrame, listed: DataFrame, key: str = "name") -> DataFrame:
    """Names cited but not listed."""
    return names.join(listed, key, "left_anti")


def only_named(items: DataFrame, parts: list[str] | None, key: str = "name") -> DataFrame:
    """Items whose name contains one of the parts; no parts: all."""
    if not parts:
        return items
    return items.where(F.exists(F.array(*[F.lit(p) for p in parts]), lambda p: F.contains(F.col(key), p)))


def listed_only(images: DataFrame, names: DataFrame, key: str = "name") -> DataFrame:
    """Images whose name a list (rows of name, blanks around it and blank lines ignored) has."""
    wanted = names.select(F.trim(F.col(key)).alias(key)).where(F.col(key) != "").distinct()
    return images.join(wanted, key, "left_semi")


def with_geo(images: DataFrame, geo: DataFrame, rel: str = "rel") -> DataFrame:
    """Images (rel, ...) that the geo index (rel, lat, lon, alt) knows, with their position."""
    return images.join(geo.select(rel, "lat", "lon", "alt"), rel)


def own_or_parent(own: DataFrame, parent: DataFrame, images: DataFrame, key: str = "chunk", seq: str = "seq") -> DataFrame:
    """Frame records of each chunk: its own (chunk, seq, ...), else those of the parent (seq, ...) whose images it has (chunk, seq)."""
    rest = images.select(key, seq).distinct().join(own.select(key).distinct(), key, "left_anti")
    return own.unionByName(rest.join(parent, seq).select(own.columns))


def envelope_choice(files: DataFrame) -> DataFrame:
    """(dir, name): of a folder's listing (dir, name) the envelope to read: envelope.json, else the older corridor.json."""
    order = F.when(F.col("name") == "envelope.json", 0).when(F.col("name") == "corridor.json", 1)
    return files.where(order.isNotNull()).groupBy("dir").agg(F.min_by("name", order).alias("name"))


def rename_plan(files: DataFrame) -> DataFrame:
    """(dir, state) of a listing (dir, name): rename where only the older envelope is, clash where both are, skip where it is renamed already."""
    has = {n: F.bool_or(F.col("name") == n) for n in ("corridor.json", "envelope.json")}
    state = F.when(F.col("_old") & F.col("_new"), "clash").when(F.col("_old"), "rename").otherwise("skip")
    out = files.where(F.col("name").isin("corridor.json", "envelope.json")).groupBy("dir").agg(has["corridor.json"].alias("_old"), has["envelope.json"].alias("_new"))
    return out.select("dir", state.alias("state"))


def refreshed(envelopes: DataFrame) -> DataFrame:
    """(chunk, version, kind, ...) of envelope versions (chunk, version, source): current for the latest, gps for the one kept aside.

    A refresh puts a solved corridor in the place of the one from positions, which is kept aside once: the latest version whose
    source is gps (or unknown) before a newer one took its place.
    """
    w = Window.partitionBy("chunk").orderBy("version")
    source = F.coalesce("source", F.lit("gps"))
    out = envelopes.withColumn("_last", F.lead("version").over(w).isNull()).withColumn("_aside", (source == "gps") & F.lead("version").over(w).isNotNull())
    aside = F.max(F.when(F.col("_aside"), F.col("version"))).over(Window.partitionBy("chunk"))
    out = out.withColumn("kind", F.when(F.col("_last"), "current").when(F.col("_aside") & (F.col("version") == aside), "gps"))
    return out.where("kind is not null").drop("_last", "_aside")


def chunk_folders(files: DataFrame) -> DataFrame:
    """(chunk, images) of a listing of paths: folders chunk_* with an images folder in them, and how many files that holds."""
    own = files.select(F.regexp_extract("path", r"(?:^|/)(chunk_[^/]*)/images/", 1).alias("chunk"))
    return own.where("chunk <> ''").groupBy("chunk").agg(F.count("*").alias("images"))


def flat_frames(paths: DataFrame) -> DataFrame:
    """Frame records (seq, path, image, t, lat, lon, alt) of single pictures, in order of their paths, without time or position."""
    none = F.lit(None).cast("double")
    return with_place(paths.select("path").distinct(), "path", name="seq").select("seq", "path", F.format_string("cam0/%06d.jpg", "seq").alias("image"), *[none.alias(c) for c in ("t", "lat", "lon", "alt")])


def by_camera(folders: DataFrame, specs: DataFrame) -> DataFrame:
    """Folders (cam like cam3) with what a list of specs (idx, ...) says of their number; folders without a number are number 0, and ones without a spec get nulls."""
    own = F.coalesce(F.nullif(F.regexp_extract("cam", r"^cam(\d+)$", 1), F.lit("")).cast("int"), F.lit(0))
    return folders.withColumn("idx", own).join(specs, "idx", "left")


def first_failed(status: DataFrame, n: int = 6) -> DataFrame:
    """(stage, failed, first): how many items of a stage failed, and the first n names."""
    w = Window.partitionBy("stage").orderBy("item")
    own = status.where("state = 'failed'")
    # Ranks beyond n are pruned before the shuffle, so a stage's failures are never sorted in one place.
    first = own.withColumn("_k", F.row_number().over(w)).where(F.col("_k") <= n).groupBy("stage").agg(F.array_sort(F.collect_list("item")).alias("first"))
    return own.groupBy("stage").agg(F.count("*").alias("failed")).join(first, "stage").select("stage", "failed", "first")


def still_to_do(items: DataFrame, done: DataFrame, keys: list[str]) -> DataFrame:
    """Items that nothing done names, each once: running it again after all are done gives none."""
    return items.dropDuplicates(keys).join(done.select(keys).distinct(), keys, "left_anti")
