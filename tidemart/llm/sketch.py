"""Threshold-scaled sketches of word shingles, with DataFrame functions only.

A sketch keeps every shingle hash below a fixed fraction of the hash range, whatever the text, so it grows with its
document, the union of the sketches of parts is the sketch of the whole's shingles, and containment between documents of
very unequal length can be estimated. Beside it stands the least hash of all shingles, which unites by minimum: texts so
short that no hash falls below the fraction are told apart by it.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemart.llm.common import once, written

WORDS = 5
FRACTION = 1 / 8  #: of all hashes that are kept
DIGITS = 12  #: hex digits kept of a hash
FAN = 128  #: cuts that a row is compared with at a time
BUCKET_BYTES = 64 << 20  #: of input files, about, whose rows meet in a task


def below(fraction: float) -> str:
    """The hex digest that hashes kept sort below."""
    return f"{math.ceil(fraction * 16**DIGITS):0{DIGITS}x}" if fraction < 1 else "g"


def words_of(text: Column) -> Column:
    return F.array_remove(F.split(text, "[ \t\n\r\f]+"), "")


def sketch(text: Column, fraction: float = FRACTION) -> Column:
    """Struct of ``least``, the smallest hash of the text's shingles of five words, and ``kept``, those below the fraction.

    ``kept`` is a sorted array of distinct strings. A text of fewer words is one shingle; one without words (null texts
    are read as empty) has no hashes: ``least`` is null, ``kept`` empty.
    """
    hashed = lambda w: F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(w) - (WORDS - 1), F.lit(1))),
        lambda i: F.substring(F.md5(F.array_join(F.slice(w, i, WORDS), " ")), 1, DIGITS),
    )
    low = lambda h: F.array_sort(F.array_distinct(F.filter(h, lambda x: x < below(fraction))))
    pair = lambda h: F.struct(F.array_min(h).alias("least"), low(h).alias("kept"))
    none = F.struct(F.lit(None).cast("string").alias("least"), F.array().cast("array<string>").alias("kept"))
    return once(words_of(F.coalesce(text, F.lit(""))), lambda w: F.when(F.size(w) > 0, once(hashed(w), pair)).otherwise(none))


def united(a: Column, b: Column) -> Column:
    """The sketch of two texts' shingles together."""
    return F.struct(
        F.coalesce(F.least(a["least"], b["least"]), a["least"], b["least"]).alias("least"),
        F.array_sort(F.array_union(a["kept"], b["kept"])).alias("kept"),
    )


def as_text(sketch_: Column) -> Column:
    """``least|hash hash ...``; a sketch without hashes is ``|``."""
    return F.concat(F.coalesce(sketch_["least"], F.lit("")), F.lit("|"), F.array_join(sketch_["kept"], " "))


def from_text(text: Column) -> Column:
    return F.struct(
        F.nullif(F.substring_index(text, "|", 1), F.lit("")).alias("least"),
        F.array_remove(F.split(F.substring_index(text, "|", -1), " "), "").alias("kept"),
    )


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity, of the hashes kept; where neither sketch has one, 1 if the least hashes are equal
    (or both missing: texts without words are alike), else 0."""
    both = F.size(F.array_intersect(a["kept"], b["kept"]))
    either = F.size(a["kept"]) + F.size(b["kept"]) - both
    return F.when(either == 0, a["least"].eqNullSafe(b["least"]).cast("double")).otherwise(both / either).cast("double")


def containment(a: Column, b: Column) -> Column:
    """Estimated share of ``a``'s shingles that ``b`` has; 1 for a text without words, null where none of ``a``'s
    hashes was kept, as nothing can be told then."""
    n = F.size(a["kept"])
    return F.when(a["least"].isNull(), F.lit(1.0)).when(n > 0, F.size(F.array_intersect(a["kept"], b["kept"])) / n).cast("double")


def key_of(id_col: str) -> Column:
    return F.struct(F.col(id_col).alias("id"), F.col("_h").alias("h"))


def cuts_of(keys: DataFrame, id_col: str, buckets: int) -> DataFrame:
    """(bucket, cut): the largest key of each of about ``buckets`` ranges of the rows (id, _h), numbered from 0 in order."""
    dealt = keys.repartitionByRange(buckets, id_col, "_h").groupBy(F.spark_partition_id().alias("_range")).agg(F.max(key_of(id_col)).alias("cut"))
    order = Window.orderBy("cut")  # a row for each range
    return written(dealt.select((F.row_number().over(order) - 1).alias("bucket"), "cut"), "cuts")


def in_buckets(rows: DataFrame, id_col: str, cuts: DataFrame, buckets: int) -> DataFrame:
    """The rows with their ``_bucket`` and its ``_cut``: the first whose cut is no smaller than the row's key.

    Cuts are looked up by joins with small tables, from coarse to fine: each row gets the ``FAN`` cuts of its group and
    picks the next group among them. So the plan has the same size for any number of buckets, and a table of cuts has a
    row for each bucket at most, which bounds what is broadcast.
    """
    levels = max(1, math.ceil(math.log(max(2, buckets), FAN) - 1e-9))
    rows = rows.withColumn("_bucket", F.lit(0).cast("long"))
    for level in reversed(range(levels)):
        stride = FAN**level  # buckets below one of the cuts
        ends = cuts.groupBy(F.floor(F.col("bucket") / stride).alias("_child")).agg(F.max("cut").alias("cut"))
        groups = ends.groupBy(F.floor(F.col("_child") / FAN).alias("_group"))
        groups = groups.agg(F.sort_array(F.collect_list("cut")).alias("_cuts"))  # FAN cuts at most
        met = rows.join(F.broadcast(groups), F.col("_bucket") == F.col("_group"))
        below = once(key_of(id_col), lambda key: F.size(F.filter("_cuts", lambda c: c < key)))
        met = met.withColumn("_at", F.least(below, F.size("_cuts") - 1))
        rows = met.select(*[c for c in rows.columns if c not in ("_bucket", "_cut")], (F.col("_bucket") * FAN + F.col("_at")).alias("_bucket"), F.col("_cuts")[F.col("_at")].alias("_cut"))
    return rows


def with_next(df: DataFrame, id_col: str, carried: list[str], buckets: int, tie: list[str] | None = None) -> DataFrame:
    """Each row with the ``carried`` columns of the next row, in order of descending id (``next`` struct).

    After the last row comes the first. Null ids come last; equal ids are ordered by a hash of the ``tie`` columns (all
    carried ones), so that rows which share an id, or have none, spread over buckets too; only rows equal in all of
    these stay together. Ids and hashes are written and dealt to ranges, whose ends cut the rows into buckets; each
    bucket also gets the first row of the bucket below, and no task holds more than a bucket. The rows themselves are
    shuffled once, and neither the plan nor the driver has anything that grows with the buckets.
    """
    hashed = F.xxhash64(*(tie or carried))
    cuts = cuts_of(written(df.select(id_col, hashed.alias("_h")), "keys"), id_col, buckets)
    rows = in_buckets(df.withColumn("_h", hashed), id_col, cuts, buckets)
    last = cuts.agg(F.max("bucket")).first()[0]  # a number
    upper = F.when(F.col("_bucket") < F.lit(last), F.col("_bucket") + 1).otherwise(0)
    own = F.struct(F.col("_bucket").alias("bucket"), F.lit(False).alias("guest"))
    guest = F.struct(upper.cast("long").alias("bucket"), F.lit(True).alias("guest"))
    is_first = key_of(id_col).eqNullSafe(F.col("_cut"))
    dealt = rows.select(id_col, "_h", *carried, F.explode(F.when(is_first, F.array(own, guest)).otherwise(F.array(own))).alias("_at"))
    dealt = dealt.select(id_col, "_h", *carried, "_at.bucket", "_at.guest")
    order = Window.partitionBy("bucket").orderBy("guest", F.col(id_col).desc_nulls_last(), F.desc("_h"))
    return dealt.withColumn("next", F.lead(F.struct(*carried)).over(order)).where(~F.col("guest")).drop("bucket", "guest", "_h")


def buckets_for(df: DataFrame) -> int:
    """Buckets that grow with the bytes of the files read, and give each core some."""
    size = int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(4 * int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), min(size, 1 << 50) // BUCKET_BYTES)


def fingerprints(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", buckets: int | None = None, fraction: float = FRACTION
) -> DataFrame:
    """Sketches of each text and of its edited text, their likeness and containment.

    The edited text has the last third of the code points replaced by the start of the next document (descending id).
    Null texts are empty; repeated rows each have a row; an empty table gives an empty result; other columns are not
    read. Texts are shuffled once, to meet their neighbours. Columns: id, n_chars, edited_sha256, fingerprint,
    edited_fingerprint, near_edited, near_next; ``kept_hashes``, the size of the sketch; ``edited_in_both``, the share
    of the edited text's shingles that the union of the sketches of its two sources contains (null: see containment).
    """
    base = df.select(id_col, F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    buckets = buckets or buckets_for(base)
    base = base.withColumn("_sketch", as_text(sketch(F.col("_text"), fraction)))  # as text: less to shuffle
    met = with_next(base, id_col, ["_text", "_sketch"], buckets, tie=["_text"])
    n = F.length("_text")
    tail = F.floor(n / 3).cast("int")
    edited = F.concat(F.col("_text").substr(F.lit(1), n - tail), F.col("next._text").substr(F.lit(1), tail))
    met = met.select(
        id_col, n.cast("long").alias("n_chars"), edited.alias("_edited"), "_sketch", F.col("next._sketch").alias("_next")
    )
    met = met.withColumns(
        {"_changed": sketch(F.col("_edited"), fraction), "_own": from_text(F.col("_sketch")), "_following": from_text(F.col("_next"))}
    )
    own, changed, following = F.col("_own"), F.col("_changed"), F.col("_following")
    return met.select(
        id_col,
        "n_chars",
        F.sha2(F.encode("_edited", "UTF-8"), 256).alias("edited_sha256"),
        F.col("_sketch").alias("fingerprint"),
        as_text(changed).alias("edited_fingerprint"),
        likeness(own, changed).alias("near_edited"),
        likeness(own, following).alias("near_next"),
        F.size(own["kept"]).cast("long").alias("kept_hashes"),
        containment(changed, united(own, following)).alias("edited_in_both"),
    )


def _duck_sketch(text: str) -> str:
    words = f"list_filter(regexp_split_to_array({text}, '[ \\t\\n\\r\\f]+'), lambda x: x <> '')"
    return f"""(select case when len(w) = 0 then {{'least': null::varchar, 'kept': []::varchar[]}}
        else {{'least': list_min(h), 'kept': list_sort(list_distinct(list_filter(h, lambda x: x < '{below(FRACTION)}')))}} end
      from (select w, list_transform(range(1, greatest(len(w) - {WORDS - 1}, 1) + 1),
        lambda i: md5(array_to_string(w[i : i + {WORDS - 1}], ' '))[1 : {DIGITS}]) as h from (select {words} as w)))"""


def _duck_text(a: str) -> str:
    return f"coalesce({a}.least, '') || '|' || array_to_string({a}.kept, ' ')"


def _duck_likeness(a: str, b: str) -> str:
    both, sizes = f"len(list_intersect({a}.kept, {b}.kept))", f"len({a}.kept) + len({b}.kept)"
    return f"case when {sizes} = 0 then ({a}.least is not distinct from {b}.least)::int::double else {both} / ({sizes} - {both})::double end::double"


SQL = f"""
with ordered as (
  select doc_id, coalesce(text, '') as text,
    coalesce(lead(coalesce(text, '')) over (order by doc_id desc),
             first_value(coalesce(text, '')) over (order by doc_id desc)) as following
  from documents
), edited as (
  select *, length(text) as n,
    substring(text, 1, length(text) - length(text) // 3) || substring(following, 1, length(text) // 3) as changed
  from ordered
), sketched as (
  select *, {_duck_sketch('text')} as a, {_duck_sketch('changed')} as b, {_duck_sketch('following')} as c from edited
)
select doc_id, n::bigint as n_chars, sha256(changed) as edited_sha256, {_duck_text('a')} as fingerprint,
  {_duck_text('b')} as edited_fingerprint, {_duck_likeness('a', 'b')} as near_edited,
  {_duck_likeness('a', 'c')} as near_next, len(a.kept)::bigint as kept_hashes,
  case when b.least is null then 1.0 when len(b.kept) > 0
    then len(list_intersect(b.kept, list_concat(a.kept, c.kept))) / len(b.kept)::double end::double as edited_in_both
from sketched
"""
