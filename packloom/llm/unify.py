"""Problem 1: one consistent form for text that looks the same.

Method: DuckDB runs inside the Arrow partitions; embedded SQL removes invisible characters by regular
expression, maps compatibility forms and look-alikes with ``translate`` and ``replace``, and composes accents
with ``nfc_normalize``.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from packloom.functions.session import settle, ship
from packloom.functions.text import not_blank
from packloom.llm import chars
from packloom.llm.classes import spelled_pairs


def canonical_sql(column: str) -> str:
    """The DuckDB expression of the consistent form; plain ASCII is that form already and is passed on."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    one, many = chars.tables()
    invisible = chars.char_class(chars.INVISIBLE, "\\x{{{:x}}}")
    e = f"nfc_normalize(regexp_replace({column}, {quote(invisible)}, '', 'g'))"
    e = f"translate({e}, {quote(''.join(one))}, {quote(''.join(one.values()))})"
    folded = f"CASE WHEN regexp_matches(u, {quote(chars.char_class([(ord(k), ord(k)) for k in sorted(many)], '\\x{{{:x}}}'))}) THEN "
    expanded = "u"
    for k, v in many.items():
        expanded = f"replace({expanded}, {quote(k)}, {quote(v)})"
    # Thai: the written order of a tone mark and the small circle doesn't show
    last = "nfc_normalize(regexp_replace(w, '\\x{e4d}([\\x{e48}-\\x{e4b}])', '\\1\u0e4d', 'g'))"
    step = lambda name, value, then: f"list_transform([{value}], lambda {name}: {then})[1]"
    body = step("u", e, step("w", f"{folded}{expanded} ELSE u END", last))
    return f"CASE WHEN regexp_full_match({column}, '[\\x00-\\x7f]*') THEN {column} ELSE {body} END"


def _session():
    import duckdb

    con = duckdb.connect()
    con.execute("SET threads = 1")
    return con


def _with_form(batches: Iterator[pa.RecordBatch], text: str, out: str) -> Iterator[pa.RecordBatch]:
    con = _session()
    sql = f"SELECT {canonical_sql('t')} AS c FROM given"
    for batch in batches:
        given = pa.table({"t": batch.column(batch.schema.get_field_index(text))})  # noqa: F841
        con.register("given", given)
        form = con.sql(sql).to_arrow_table().column("c").combine_chunks().cast(pa.string())
        con.unregister("given")
        if isinstance(form, pa.ChunkedArray):
            form = pa.concat_arrays(form.chunks) if form.num_chunks else pa.array([], pa.string())
        yield pa.RecordBatch.from_arrays([*batch.columns, form], [*batch.schema.names, out])


def with_form(df: DataFrame, text: str = "text", out: str = "canonical") -> DataFrame:
    """``df`` with the consistent form of column ``text`` in the new column ``out``.

    Null gives null and an empty text an empty one; every other row, repeated or not, gets its own form, so equal
    texts get equal forms. Very long texts are taken whole. An empty table gives an empty table. Extra columns pass
    unchanged; a column named ``out`` that exists already raises ValueError.
    """
    if out in df.columns:
        raise ValueError(f"column {out!r} exists already")
    ship(df.sparkSession)
    schema = T.StructType([*df.schema.fields, T.StructField(out, T.StringType())])
    return df.mapInArrow(lambda batches: _with_form(batches, text, out), schema)


def alike_pairs(df: DataFrame, key: str, text: str = "text") -> DataFrame:
    """Pairs (``a``, ``b``), ``a`` < ``b``, of keys whose texts differ in code points but have the same form.

    Null and blank texts are in no pair; exact copies are in pairs with other spellings, not with each other.
    Rows are joined as classes of exact copies, so a form that a third of all rows share costs no more than its
    result. Rows with a null key are left out, repeated (key, text) rows count once; ties can't arise.
    """
    rows = with_form(df.select(F.col(key).alias("k"), F.col(text).alias("t")).where("k is not null and t is not null"), "t", "c")
    rows = rows.where(not_blank("c")).select("k", F.md5("c").alias("form"), F.md5("t").alias("raw"))
    rows, _ = settle(rows)  # else each of the joins below runs DuckDB anew
    return spelled_pairs(rows, ["form"]).select("a", "b")
