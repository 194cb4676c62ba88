"""Column helpers the operators share; all expressions stay in the JVM."""

from __future__ import annotations

import re
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame, functions as F

Name = str | Column


def col(x: Name) -> Column:
    return F.col(x) if isinstance(x, str) else x


# -- names


def snake_name(name: str) -> str:
    """Title Case, camelCase and punctuated headers as snake_case."""
    name = re.sub(r"(?<=[a-z0-9])(?=[A-Z])", "_", name)
    return re.sub(r"_+", "_", re.sub(r"[^a-zA-Z0-9]+", "_", name)).strip("_").lower()


def snake_columns(df: DataFrame) -> DataFrame:
    """All columns renamed to snake_case; two headers that would share a name are an error."""
    names = [snake_name(c) for c in df.columns]
    clash = sorted({n for n in names if names.count(n) > 1})
    if clash:
        raise ValueError(f"headers share the names {clash}")
    return df.toDF(*names)


# -- text


def trimmed(x: Name) -> Column:
    return F.trim(col(x))


def blank_to_null(x: Name) -> Column:
    return F.nullif(trimmed(x), F.lit(""))


def squeezed(x: Name) -> Column:
    """Trimmed, runs of white space as one space."""
    return F.regexp_replace(trimmed(x), r"\s+", " ")


def location(city: Name, state: Name, country: Name) -> Column:
    return F.concat_ws(", ", blank_to_null(city), blank_to_null(state), blank_to_null(country))


def not_blank(x: Name) -> Column:
    return col(x).isNotNull() & (trimmed(x) != "")


# -- casts that give null on bad text


def to_date_or_null(x: Name, formats: Sequence[str] = ("dd-MM-yyyy",)) -> Column:
    return F.coalesce(*[F.try_to_date(col(x), f) for f in formats])


def cast_or_null(x: Name, kind: str) -> Column:
    return col(x).try_cast(kind)


# -- numbers


def capped(x: Name, most: float) -> Column:
    """Values above ``most`` become ``most``; null stays null."""
    return F.when(col(x) > most, F.lit(most)).otherwise(col(x))


def money_sum(x: Name) -> Column:
    """A sum that no order of addition changes: exact to four decimals, as double."""
    return F.sum(col(x).cast("decimal(18,4)")).cast("double")


def fine_sum(x: Name) -> Column:
    """The same to eight decimals, for sums that stay small."""
    return F.sum(col(x).cast("decimal(20,8)")).cast("double")


def money_avg(x: Name) -> Column:
    return money_sum(x) / F.count(col(x))


def fine_avg(x: Name) -> Column:
    return fine_sum(x) / F.count(col(x))


def fraction_avg(x: Name) -> Column:
    """The mean of ratios around one, exact to twelve decimals."""
    return F.sum(col(x).cast("decimal(24,12)")).cast("double") / F.count(col(x))


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero."""
    return a / F.nullif(b, F.lit(0).cast("double"))


def percent_of(part: Name, whole: Name) -> Column:
    """Percentage to two decimals."""
    return F.round((100 * col(part).cast("decimal(18,4)") / F.nullif(col(whole), F.lit(0))).cast("decimal(18,6)"), 2).cast("double")


def number_text(x: Name) -> Column:
    """A double as text: the fewest digits that read back as it, plain from 0.0001 up to 1e16, else as ``1.5e-07``.

    A cast would write 36000000 as ``3.6E7``. Not for NaN or infinity; beyond 1e16 the last digit may be one off.
    """
    v = col(x).cast("double")
    written = F.array(*[F.format_string(f"%.{digits}e", v) for digits in range(17)])
    short = F.try_element_at(F.filter(written, lambda w: w.try_cast("double") == v), F.lit(1))
    plain = F.regexp_replace(F.regexp_replace(short.try_cast("decimal(38,20)").cast("string"), "0+$", ""), r"\.$", ".0")
    return F.when(v == 0, "0.0").when((F.abs(v) >= 1e-4) & (F.abs(v) < 1e16), plain).otherwise(short)


def known(df: DataFrame, name: str) -> Column:
    """Whether a column has a value: what ``has_<name>`` says, where rows carry that in its place."""
    return F.col(f"has_{name}") if f"has_{name}" in df.columns else F.col(name).isNotNull()


# -- labels and scores


def bucket(x: Name, steps: Iterable[tuple[float, str]], rest: str, below: bool = True, inclusive: bool = False) -> Column:
    """The first label whose bound holds: ``x < bound`` (or ``<=``), or with ``below=False`` ``x >= bound``; else ``rest``."""
    x, out = col(x), None
    for bound, label in steps:
        holds = (x <= bound if inclusive else x < bound) if below else x >= bound
        out = F.when(holds, label) if out is None else out.when(holds, label)
    return out.otherwise(rest)


def quality_score(weights: Iterable[tuple[Column, int]]) -> Column:
    """The sum of the weights whose predicates hold; an unknown predicate counts nothing."""
    total = F.lit(0)
    for holds, weight in weights:
        total = total + F.when(holds, weight).otherwise(0)
    return total


def first_fault(faults: Iterable[tuple[str, Column]]) -> Column:
    """The name of the first predicate that holds, else null."""
    out = None
    for name, holds in faults:
        out = F.when(holds, name) if out is None else out.when(holds, name)
    return out


# -- keys

NULL_KEY = "_null_"


def surrogate_key(*fields: Name) -> Column:
    """MD5 over the fields as text, joined by ``-``; null has a text of its own."""
    return F.md5(F.concat_ws("-", *[F.coalesce(col(f).cast("string"), F.lit(NULL_KEY)) for f in fields]))


def plain_key(*fields: Name) -> Column:
    """Upper-case MD5 over the concatenated fields, null as empty."""
    return F.upper(F.md5(F.concat(*[F.coalesce(col(f).cast("string"), F.lit("")) for f in fields])))


def row_hash(*fields: Name) -> Column:
    """SHA-256 over the fields joined by two pipes, null as empty."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(col(f), F.lit("")) for f in fields]), 256)


# -- dates


def day_number(d: Name) -> Column:
    """0 for Sunday to 6 for Saturday."""
    return F.dayofweek(col(d)) - 1


def date_key(d: Name) -> Column:
    return F.date_format(col(d), "yyyyMMdd").cast("int")


def years_between(a: Name, b: Name) -> Column:
    """Calendar-year boundaries from a to b."""
    return F.year(col(b)) - F.year(col(a))


def day_part(hour: Name) -> Column:
    h = col(hour)
    return (
        F.when(h.between(6, 11), "MORNING").when(h.between(12, 17), "AFTERNOON").when(h.between(18, 21), "EVENING").otherwise("NIGHT")
    )


# -- audit


def audit_columns(at: Column, run: str = "local", target: str = "dev") -> dict[str, Column]:
    return {"created_at": at, "updated_at": at, "invocation_id": F.lit(run), "target_name": F.lit(target)}


def scd2_audit_columns(effective: Name, expires: Name, end, at: Column, **kw: str) -> dict[str, Column]:
    return {
        "effective_from": col(effective),
        "effective_to": col(expires),
        "is_current": F.coalesce(col(expires) == F.lit(end), F.lit(False)),
    } | audit_columns(at, **kw)


# Names of upstream sources.
SOURCE_SYSTEMS = {
    "sales_raw": "KAFKA_STREAMING",
    "sales_batch_raw": "SPARK_BATCH",
    "product_raw": "PRODUCT_MASTER",
    "store_raw": "STORE_MASTER",
}


def source_system_of(x: Name) -> Column:
    out = F.lit("UNKNOWN")
    for name, system in SOURCE_SYSTEMS.items():
        out = F.when(col(x) == name, system).otherwise(out)
    return out
