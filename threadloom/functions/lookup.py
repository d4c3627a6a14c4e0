"""Look up every token of an array column in a table, keeping the array's shape and order."""

from __future__ import annotations

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import StructType

from threadloom.sizing import BROADCAST_ROWS

SALTS = 32


def lookup_tokens(
    df: DataFrame, key: str, tokens: str, table: DataFrame, term: str, out: str, max_rows: int = BROADCAST_ROWS
) -> DataFrame:
    """Add `out`: for each token the struct of the table's other columns, NULL where the token is not in the table.

    A table of up to max_rows rows travels with the tasks and is applied to whole Arrow arrays: no shuffle, no work per
    row. A larger one is joined: the tokens of each distinct (key, tokens) are exploded and come back grouped by it. Of
    several table rows for one term the smallest counts, so both ways give the same arrays.
    """
    table = _one_per_term(table, term)
    values = table.drop(term)
    rows = small_table(table, term, max_rows)
    if rows is not None:
        return _apply_small(df, tokens, rows, term, values.schema, out)
    return _apply_joined(df, key, tokens, table, term, values.columns, out)


def _one_per_term(table: DataFrame, term: str) -> DataFrame:
    names = [c for c in table.columns if c != term]
    least = table.groupBy(term).agg(F.min(F.struct(*names)).alias("_least"))
    return least.select(term, *[F.col("_least")[c].alias(c) for c in names])


def small_table(table: DataFrame, term: str, max_rows: int = BROADCAST_ROWS) -> pa.Table | None:
    """The table with its smallest row for each term, or None when that is more than max_rows rows."""
    rows = _one_per_term(table, term).limit(max_rows + 1).toArrow()
    return rows if rows.num_rows <= max_rows else None


def _apply_small(df, tokens: str, rows: pa.Table, term: str, schema: StructType, out: str) -> DataFrame:
    terms = rows.column(term).combine_chunks()
    columns = {name: rows.column(name).combine_chunks() for name in schema.fieldNames()}

    @F.arrow_udf(f"array<{schema.simpleString()}>")
    def apply(batch: pa.Array) -> pa.Array:
        flat = batch.flatten()
        at = pc.index_in(flat, value_set=terms)
        found = pa.StructArray.from_arrays(
            [column.take(at) for column in columns.values()], names=list(columns), mask=pc.is_null(at)
        )
        lengths = pc.fill_null(pc.list_value_length(batch), 0)
        offsets = pa.concat_arrays([pa.array([0], pa.int32()), pc.cumulative_sum(lengths).cast(pa.int32())])
        return pa.ListArray.from_arrays(offsets, found, mask=pc.is_null(batch))

    # Declared non-deterministic so that filters are not pushed below it with a second copy of the lookup.
    return df.withColumn(out, apply.asNondeterministic()(tokens))


def _apply_joined(df, key: str, tokens: str, table: DataFrame, term: str, values: list[str], out: str) -> DataFrame:
    # Frequent tokens are spread over SALTS copies of the table, so that no join partition holds all of one token.
    salted = table.select(
        F.col(term).alias("_token"),
        F.struct(*values).alias("_found"),
        F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("_salt"),
    )
    same = F.xxhash64(tokens)
    source = df.where(F.col(key).isNotNull()).select(key, tokens, same.alias("_tokens")).dropDuplicates([key, "_tokens"])
    exploded = source.select(key, "_tokens", F.posexplode(tokens).alias("_pos", "_token")).withColumn(
        "_salt", F.pmod(F.xxhash64(key), F.lit(SALTS)).cast("int")
    )
    collected = (
        exploded.join(salted, ["_token", "_salt"], "left")
        .groupBy(key, "_tokens")
        .agg(F.sort_array(F.collect_list(F.struct("_pos", "_found"))).alias("_cells"))
        .select(key, "_tokens", F.transform("_cells", lambda cell: cell["_found"]).alias(out))
    )
    joined = df.withColumn("_tokens", same).join(collected, [key, "_tokens"], "left").drop("_tokens")
    empty = F.array().cast(collected.schema[out].dataType)
    return joined.withColumn(out, F.when(F.col(tokens).isNotNull(), F.coalesce(out, empty)))
