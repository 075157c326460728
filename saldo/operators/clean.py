"""Raw text rows to typed sales rows.

The order of the steps is part of the result: numbers and dates are coerced, then the
first copy of each row id is kept, then incomplete rows go. An incomplete first copy thus
takes its complete second copy with it.
"""

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saldo.functions import cells
from saldo.functions.barrier import once
from saldo.schema import CLEAN, HEADERS, REQUIRED_AFTER_COERCION, STRIPPED

# Where a row stood in its source; readers that know it add these columns.
POSITION = ("_source_file", "_source_block", "_source_row")

#: Texts of the numbers of a row that their columns do not hold, a field each; NULL where there is none.
OVERFLOW = "_overflow"
NUMBERS = ("sales", "profit", "quantity", "discount")
MARKED = (*NUMBERS, "row_id", "date_key")


def check_headers(raw: DataFrame) -> DataFrame:
    absent = sorted(set(HEADERS) - set(raw.columns))
    if absent:
        raise ValueError(f"missing columns: {absent}")
    return raw


def rename_headers(raw: DataFrame) -> DataFrame:
    return raw.withColumnsRenamed(HEADERS)


def mark_of(column: str) -> Column:
    """The text that OVERFLOW holds of a column, NULL if none."""
    return F.col(OVERFLOW)[column]


def marks(df: DataFrame, texts: dict[str, Column]) -> Column:
    """OVERFLOW with these texts besides those that `df` has of other columns."""
    before = OVERFLOW in df.columns
    texts = {c: texts[c] if c in texts else mark_of(c) if before else F.lit(None).cast("string") for c in MARKED}
    return F.when(F.coalesce(*texts.values()).isNotNull(), F.struct(*[t.alias(c) for c, t in texts.items()]))


def coerce_numbers(df: DataFrame) -> DataFrame:
    """sales, profit, quantity: NULL where not a number; discount: 0 there. OVERFLOW is added.

    A number beyond the type is NULL too, with its text in OVERFLOW. Each text is parsed once.
    """
    parsed = once(df, {f"_{c}": cells.to_number(F.col(c)) for c in NUMBERS})
    texts = once(parsed, {f"_text_{c}": cells.beyond(F.col(c), F.col(f"_{c}")) for c in NUMBERS})
    beyond = once(texts, {OVERFLOW: marks(parsed, {c: F.col(f"_text_{c}") for c in NUMBERS})})
    discount = F.when(F.col("_discount").isNull() & mark_of("discount").isNull(), 0).otherwise(F.col("_discount"))
    return beyond.withColumns({
        **{c: F.col(f"_{c}") for c in NUMBERS}, "discount": discount.cast(cells.NUMBER),
    }).drop(*[f"{p}{c}" for c in NUMBERS for p in ("_", "_text_")])


def coerce_dates(df: DataFrame, formats: Sequence[str] = cells.DATE_FORMATS) -> DataFrame:
    """order_date as a date, NULL where none of the formats fits. Each text is parsed once."""
    day = once(df, {"order_date": cells.without_time(F.col("order_date"))})
    return once(day, {"order_date": cells.day_of(F.col("order_date"), formats)})


def source_order(df: DataFrame) -> list[Column]:
    """Row order of the source if known, else the order of all values."""
    known = [c for c in POSITION if c in df.columns] or [c for c in df.columns if c != OVERFLOW]
    return [F.col(c).asc_nulls_first() for c in known]


def dedupe_first(df: DataFrame, keys: Sequence[str] = ("row_id",),
                 order: Sequence[Column] | None = None) -> DataFrame:
    """First row of each key in `order`; rows with a NULL key are copies of each other.

    The rank filter lets Spark keep one row per key in every task before the shuffle, so a
    key with a large part of all rows arrives as one row per task.
    """
    window = Window.partitionBy(*keys).orderBy(*(order or source_order(df)))
    ranked = df.withColumn("_rank", F.row_number().over(window))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def complete(df: DataFrame, required: Sequence[str] = REQUIRED_AFTER_COERCION) -> Column:
    """Whether a row has all required values; a number that OVERFLOW holds is one."""
    def there(c: str) -> Column:
        known = F.col(c).isNotNull()
        return known | mark_of(c).isNotNull() if c in NUMBERS and OVERFLOW in df.columns else known
    return reduce(and_, map(there, required))


def drop_incomplete(df: DataFrame, required: Sequence[str] = REQUIRED_AFTER_COERCION) -> DataFrame:
    return df.filter(complete(df, required))


def add_date_parts(df: DataFrame, date: str = "order_date") -> DataFrame:
    d = F.col(date)
    return df.withColumns({
        "year": F.year(d),
        "month": F.month(d),
        "quarter": F.quarter(d),
        "year_month": cells.month_key(d),
    })


def strip_texts(df: DataFrame, columns: Sequence[str] = STRIPPED) -> DataFrame:
    return df.withColumns({c: cells.strip(F.col(c)) for c in columns})


def apply_types(df: DataFrame) -> DataFrame:
    """Final column types. A number that does not fit its type is NULL, with its text in OVERFLOW."""
    whole = {c: cells.to_whole(F.col(c)) for c in ("row_id", "date_key")}
    types = {f.name: f.dataType for f in CLEAN.fields}
    typed = {c: F.col(c).try_cast(t) for c, t in types.items()} | {
        "row_id": whole["row_id"], "date_key": cells.to_int(whole["date_key"]),
        "quantity": cells.to_int(F.round("quantity", 0))}
    named = once(df, {f"_typed_{c}": typed[c] for c in (*whole, "quantity")})
    beyond = {c: cells.beyond(F.col(c), F.col(f"_typed_{c}")) for c in whole}
    beyond["quantity"] = F.coalesce(mark_of("quantity"), cells.beyond(F.col("quantity").cast("string"), F.col("_typed_quantity")))
    final = [F.col(f"_typed_{c}").alias(c) if c in beyond else typed[c].alias(c) for c in types]
    known = {*types, *POSITION, "_row_key", OVERFLOW}
    others = [F.col(f"`{c}`") for c in df.columns if c not in known]
    return named.select(*final, *others, marks(named, beyond).alias(OVERFLOW))


def _with_row_key(df: DataFrame) -> DataFrame:
    """Key of the deduplication: '7', '07' and '7.0' are one id, 'x' and 'y' are two."""
    text = F.col("row_id")
    return df.withColumn("_row_key", F.coalesce(cells.to_whole(text).cast("string"), text))


def coerce(raw: DataFrame, formats: Sequence[str] = cells.DATE_FORMATS) -> DataFrame:
    return (
        raw.transform(check_headers)
        .transform(rename_headers)
        .transform(coerce_numbers)
        .transform(coerce_dates, formats)
        .transform(_with_row_key)
    )


def clean(raw: DataFrame, formats: Sequence[str] = cells.DATE_FORMATS, *, overflow: bool = False) -> DataFrame:
    """Whole cleaning step over a raw frame with the 19 headers; other columns pass through.

    Numbers too large for their columns are NULL; with `overflow`, OVERFLOW names them and
    holds their texts.
    """
    done = (
        coerce(raw, formats)
        .transform(dedupe_first, ("_row_key",))
        .transform(drop_incomplete)
        .transform(add_date_parts)
        .transform(strip_texts)
        .transform(apply_types)
    )
    return done if overflow else done.drop(OVERFLOW)


def clean_counts(raw: DataFrame, formats: Sequence[str] = cells.DATE_FORMATS) -> DataFrame:
    """One row: rows read, rows with a bad date, rows removed, rows left.

    Each key is folded to three numbers before the shuffle, so no full row travels when the
    source position is known.
    """
    coerced = coerce(raw, formats)
    position = [c for c in POSITION if c in raw.columns] or [c for c in coerced.columns if c != OVERFLOW]
    per_key = (
        coerced.select(
            "_row_key",
            F.col("order_date").isNull().cast("int").alias("bad_date"),
            complete(coerced).cast("int").alias("complete"),
            F.struct(*position).alias("position"),
        )
        .groupBy("_row_key")
        .agg(
            F.count("*").alias("read"),
            F.sum("bad_date").alias("bad"),
            F.min_by("complete", "position").alias("kept"),
        )
    )
    return per_key.agg(
        F.coalesce(F.sum("read"), F.lit(0)).alias("linhas_originais"),
        F.coalesce(F.sum("bad"), F.lit(0)).alias("datas_invalidas"),
        F.coalesce(F.sum("read") - F.sum("kept"), F.lit(0)).alias("removidas"),
        F.coalesce(F.sum("kept"), F.lit(0)).alias("restantes"),
    )
