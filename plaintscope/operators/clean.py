"""Cleaning, keep-last dedup and keyed upsert.

Scale notes: dedup takes two passes. Repeated keys are found on the key column alone; rows of
other keys pass a map-side anti-join and are never shuffled. Only rows of repeated keys (and an
upsert's touched rows) meet in an aggregate on the key with ``max_by(struct(row), order)``, which
combines on the map side, so a key repeated millions of times is collapsed before the shuffle.
Spark plans it as a sort aggregate (a struct with strings is no mutable buffer).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import COMPLAINT_SCHEMA, DATE_COLUMNS, LOAD_COLUMNS, REQUIRED_COLUMNS, TRIMMED_COLUMNS
from ..functions.scalar import blank_to_null
from ..session import BROADCAST_MAX_ROWS, bounded_broadcast, cut_lineage

# The shapes of date text that are read: year first or month first, one or two digits
# for month, day and hour, then perhaps a time with seconds and up to nine decimals, and an offset
# (Z, +hh, +hhmm, +hh:mm).
_TIME = r"([T ]\d{1,2}:\d{2}(:\d{2}(\.\d{1,9})?)? ?(Z|[+-]\d{2}(:?\d{2})?)?)?"
DATE_SHAPE = rf"^(\d{{4}}-\d{{1,2}}-\d{{1,2}}|\d{{4}}/\d{{1,2}}/\d{{1,2}}|\d{{1,2}}/\d{{1,2}}/\d{{4}}){_TIME}$"
# Rewritten one after the other into the one form that is parsed.
DATE_FORMS = (
    (r"^(\d{1,2})/(\d{1,2})/(\d{4})", "$3-$1-$2"),
    (r"^(\d{4})/(\d{1,2})/", "$1-$2-"),
    (r"([T ]\d{1,2}:\d{2})(?= ?(?:$|Z|[+-]))", "$1:00"),
    (r" (?=Z|[+-])", ""),
)


def normalize_name(name: str) -> str:
    """B1: strip, lower-case, drop '?', '-' -> '_', ' ' -> '_'."""
    return name.strip().lower().replace("?", "").replace("-", "_").replace(" ", "_")


def normalize_columns(df: DataFrame) -> DataFrame:
    """B1 on every column (metadata only)."""
    return df.toDF(*[normalize_name(c) for c in df.columns])


def coerce_timestamp(c) -> Column:
    """B2 + B3: text -> UTC wall-clock TIMESTAMP_NTZ; text of no known shape, or of no real date
    and time -> NULL. Parsed once: the text is brought into one form by its shape.

    Offsets are honoured (converted to UTC, session zone is UTC) and then dropped.
    """
    c = F.col(c) if isinstance(c, str) else c
    t = F.regexp_replace(c, r"^[\s\p{Z}]+|[\s\p{Z}]+$", "")
    form = t
    for shape, to in DATE_FORMS:
        form = F.regexp_replace(form, shape, to)
    # Session zone is UTC, so the NTZ cast keeps the UTC wall clock.
    return F.when(t.rlike(DATE_SHAPE), form.try_cast("timestamp")).cast("timestamp_ntz")


def whole_number(text: Column) -> Column:
    """Text of a whole number within 64 bits, exactly ('7', '7.0', '7e2'); else NULL."""
    exact = text.try_cast("decimal(38,10)")
    return F.when(exact == F.floor(exact), F.floor(exact).try_cast("bigint"))


def clean_id(c: Column) -> Column:
    return whole_number(F.regexp_replace(c.cast("string"), r"^[\s\p{Z}]+|[\s\p{Z}]+$", ""))


def standardize(df: DataFrame) -> DataFrame:
    """B2-B4 on a name-normalised raw frame: typed id and dates, trimmed text.

    Whitespace-only text becomes NULL (so a blank required field is rejected).
    """
    out = []
    for name in df.columns:
        c = F.col(name)
        if name == "complaint_id":
            c = clean_id(c)
        elif name in DATE_COLUMNS:
            c = coerce_timestamp(c)
        elif name in TRIMMED_COLUMNS:
            c = blank_to_null(c)
        out.append(c.alias(name))
    return df.select(*out)


def missing_required(required=REQUIRED_COLUMNS) -> Column:
    """B5 predicate: any required field missing."""
    cond = F.lit(False)
    for c in required:
        cond = cond | F.col(c).isNull()
    return cond


def reject_missing(df: DataFrame, required=REQUIRED_COLUMNS) -> DataFrame:
    """Keep rows with every required field (run before dedup)."""
    return df.where(~missing_required(required))


def repeated_keys(keyed: DataFrame, key: str) -> DataFrame | None:
    """First pass of a two-pass dedup: the keys (``_key``, NULL too) held by more than one row,
    found on the key column alone and written. None if there are more than may be broadcast."""
    found = cut_lineage(keyed.groupBy(F.col(f"`{key}`").alias("_key")).agg(F.count(F.lit(1)).alias("n"))
                        .where("n > 1").select("_key"))
    return found if found.limit(BROADCAST_MAX_ROWS + 1).count() <= BROADCAST_MAX_ROWS else None


def by_repetition(df: DataFrame, key: str, repeated: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The rows of keys held once and the others, by map-side joins."""
    k = F.broadcast(repeated)
    same = df[f"`{key}`"].eqNullSafe(k["_key"])
    return df.join(k, same, "left_anti"), df.join(k, same, "left_semi")


def dedup_keep_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """one row per key, the one with the greatest `order` tuple (= last in input order).

    Two passes: repeated keys are found on the key alone, and only their rows are shuffled into the
    keyed aggregate; all others pass as they are. Beyond the broadcast bound all rows go through it."""
    repeated = repeated_keys(df.select(F.col(f"`{key}`")), key)
    if repeated is None:
        return _keep_last(df, key, order)
    once, more = by_repetition(df, key, repeated)
    columns = [F.col(f"`{key}`"), *[F.col(f"`{c}`") for c in df.columns if c != key]]
    return once.select(*columns).unionByName(_keep_last(more, key, order))


def _keep_last(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    payload = [c for c in df.columns if c != key]
    ordered = F.struct(*[F.col(f"`{o}`") for o in order])
    row = F.col("_row")
    return (df.groupBy(F.col(f"`{key}`"))
            .agg(F.max_by(F.struct(*[F.col(f"`{c}`") for c in payload]), ordered).alias("_row"))
            .select(F.col(f"`{key}`"), *[row.getField(c).alias(c) for c in payload]))


def clean_complaints(raw: DataFrame, order: list[str], sort: bool = True) -> DataFrame:
    """B1-B5 + F1 + G1 over a raw extract carrying explicit input-order columns.

    ``order`` names columns (already in ``raw``) that give input order; they are
    dropped from the result. Rejection (B5) happens before dedup, so an older
    valid row survives a newer invalid duplicate: an invalid row gets a NULL
    ordering value, which ``max_by`` skips. Folding the test into the aggregate
    (instead of a Filter) keeps Catalyst from pushing a copy of every cleaning
    expression below the shuffle and evaluating it twice.

    Dedup is two-pass (see ``dedup_keep_last``): the first pass reads the id alone; the rows of
    ids held once never leave their task.
    """
    id_name = next(c for c in raw.columns if c not in order and normalize_name(c) == "complaint_id")
    staged = raw.withColumn("__id", clean_id(F.col(f"`{id_name}`")))
    repeated = repeated_keys(staged.select("__id"), "__id")
    if repeated is None:
        out = _last_valid(_standardize_keep(raw, order), len(order))
    else:
        once, more = (x.drop("__id") for x in by_repetition(staged, "__id", repeated))
        out = _valid_rows(_standardize_keep(once, order)).unionByName(
            _last_valid(_standardize_keep(more, order), len(order)))
    return out.orderBy("date_received", "complaint_id") if sort else out


def _columns(std: DataFrame) -> list[str]:
    return [c for c in LOAD_COLUMNS if c in std.columns and c != "complaint_id"]


def _valid_rows(std: DataFrame) -> DataFrame:
    """The valid rows. The test refers to a value that is not fixed by the row, so Catalyst leaves
    the Filter above the projection and cleans each field once."""
    pinned = std.withColumn("__pin", F.monotonically_increasing_id())
    return pinned.where((F.col("__pin") >= 0) & ~missing_required()).select("complaint_id", *_columns(std))


def _last_valid(std: DataFrame, n_order: int) -> DataFrame:
    """Per id its last valid row."""
    ord_cols = [f"__ord{i}" for i in range(n_order)]
    payload = _columns(std)
    valid_order = F.when(~missing_required(), F.struct(*[F.col(o) for o in ord_cols]))
    row = F.col("_row")
    return (std.groupBy("complaint_id")
            .agg(F.max_by(F.struct(*payload), valid_order).alias("_row"))
            .where(row.isNotNull())
            .select("complaint_id", *[row.getField(c).alias(c) for c in payload]))


def _standardize_keep(raw: DataFrame, order: list[str]) -> DataFrame:
    """B1-B4 on the data columns; the order columns are carried as __ord0, __ord1, ..."""
    renamed = raw.select(
        *[F.col(f"`{c}`").alias(normalize_name(c)) for c in raw.columns if c not in order],
        *[F.col(f"`{o}`").alias(f"__ord{i}") for i, o in enumerate(order)])
    return standardize(renamed)


def clean_summary(raw: DataFrame, order: list[str]) -> DataFrame:
    """Counts of the clean step: raw rows, rejected rows, duplicate ids removed, clean rows.

    Validity is counted inside the aggregates (no Filter on the cleaned columns,
    which Catalyst would push below the projection and evaluate twice)."""
    std = _standardize_keep(raw, order)
    valid = ~missing_required()
    per_key = std.groupBy("complaint_id").agg(F.count_if(valid).alias("n"),
                                              F.count(F.lit(1)).alias("rows"))
    totals = per_key.agg(F.sum("rows").cast("bigint").alias("raw_records"),
                         F.sum(F.col("rows") - F.col("n")).cast("bigint").alias("rejected_missing_required"),
                         F.sum(F.greatest(F.col("n") - 1, F.lit(0))).cast("bigint")
                         .alias("duplicate_ids_removed"),
                         F.count_if(F.col("n") > 0).alias("clean_records"))
    return totals


def conform(df: DataFrame, schema=COMPLAINT_SCHEMA) -> DataFrame:
    """Columns of the typed complaint table in load order, cast to their types
    (absent columns are NULL; extra columns are dropped)."""
    return df.select(*[(F.col(f.name) if f.name in df.columns else F.lit(None))
                       .cast(f.dataType).alias(f.name) for f in schema.fields])


def upsert(existing: DataFrame, incoming: DataFrame, key: str = "complaint_id",
           seq: str | None = None, batch_ts=None, valid=None,
           max_broadcast_keys: int = BROADCAST_MAX_ROWS, keys: DataFrame | None = None) -> DataFrame:
    """Keyed upsert. An incoming row replaces every column (NULLs included) but
    ``ingested_at``; within the batch the last row (greatest ``seq``) wins. New keys
    get ``batch_ts`` (default: current timestamp) as ``ingested_at``. ``valid`` (a
    boolean Column over ``incoming``) excludes rejected batch rows inside the
    aggregate rather than by a Filter.

    Only existing rows whose key occurs in the batch can change: every other row,
    repeated or not, passes through an anti-join untouched, and only the touched rows
    meet the batch in the keyed aggregate. When the batch's distinct keys are measured
    to fit ``max_broadcast_keys`` both joins are map-side (no shuffle of the table);
    above the bound they are shuffle joins with the same result. ``keys`` (``_key``, written)
    spares that step a caller who has it.

    The result is a new DataFrame; write it to a new location and switch readers
    over on success (all-or-nothing, the input is never overwritten in place).
    """
    # The table's columns (load order first); extra batch columns are not stored.
    shared = [c for c in incoming.columns if c in existing.columns and c not in (seq, "ingested_at")]
    cols = [c for c in LOAD_COLUMNS if c in shared] + [c for c in shared if c not in LOAD_COLUMNS]
    old = existing.select(*cols, F.col("ingested_at").cast("timestamp_ntz"))
    # The batch's distinct keys are written once (keys only): the size check and the
    # broadcast read them instead of re-evaluating the batch.
    if keys is None:
        keys = cut_lineage(incoming.select(F.col(key).alias("_key")).distinct())
    bk = bounded_broadcast(keys, max_broadcast_keys)
    hit = old[key].eqNullSafe(bk["_key"])  # NULL keys group together, as in the aggregate
    untouched = old.join(bk, hit, "left_anti")
    touched = old.join(bk, hit, "left_semi")
    merged = _merge(touched, incoming, key, cols, seq, batch_ts, valid)
    # Same column order as the merge alone: key, payload, ingested_at.
    return untouched.select(*merged.columns).unionByName(merged)


def _merge(old: DataFrame, incoming: DataFrame, key: str, cols: list[str], seq: str | None,
           batch_ts, valid) -> DataFrame:
    """Keyed last-wins merge of existing rows (order 0) and batch rows (order 1, seq)."""
    ts = (F.current_timestamp() if batch_ts is None else F.lit(batch_ts)).cast("timestamp_ntz")
    new_seq = F.col(seq).cast("bigint") if seq else F.monotonically_increasing_id()
    ok = F.lit(True) if valid is None else valid
    old = old.select(*cols, "ingested_at", F.lit(0).alias("_src"),
                     F.lit(0).cast("bigint").alias("_seq"), F.lit(True).alias("_ok"))
    new = incoming.select(*cols, F.lit(None).cast("timestamp_ntz").alias("ingested_at"),
                          F.lit(1).alias("_src"), new_seq.alias("_seq"), ok.alias("_ok"))
    payload = [c for c in cols if c != key]
    both = old.unionByName(new)
    order = F.when(F.col("_ok"), F.struct("_src", "_seq"))
    return (both.groupBy(key)
            .agg(F.max_by(F.struct(*payload), order).alias("_row"),
                 F.min("ingested_at").alias("_first"))
            .where(F.col("_row").isNotNull())
            .select(key, *[F.col("_row").getField(c).alias(c) for c in payload],
                    F.coalesce("_first", ts).alias("ingested_at")))
