"""Column types of the tables this package reads."""

from __future__ import annotations

from pyspark.sql.types import (
    ArrayType,
    DateType,
    DoubleType,
    FloatType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _schema(**columns) -> StructType:
    return StructType([StructField(name, kind) for name, kind in columns.items()])


_S, _D, _I, _L, _T = StringType(), DoubleType(), IntegerType(), LongType(), TimestampNTZType()

MEASUREMENTS = _schema(Species=_S, Weight=_D, Length1=_D, Length2=_D, Length3=_D, Height=_D, Width=_D)
ARTICLES = _schema(date=_S, url=_S, press=_S, title=_S, section=_S)
SCORE = _schema(date=DateType(), score=_D)
ANCHOR_SCORES = _schema(date=DateType(), up=_D, flat=_D, down=_D)

TABLES = {
    "region": _schema(r_regionkey=_I, r_name=_S),
    "nation": _schema(n_nationkey=_I, n_name=_S, n_regionkey=_I),
    "customer": _schema(c_custkey=_L, c_name=_S, c_nationkey=_I, c_acctbal=_D, c_mktsegment=_S),
    "supplier": _schema(s_suppkey=_L, s_name=_S, s_nationkey=_I, s_acctbal=_D),
    "part": _schema(p_partkey=_L, p_name=_S, p_brand=_S, p_type=_S, p_size=_I, p_retailprice=_D),
    "orders": _schema(
        o_orderkey=_L, o_custkey=_L, o_orderstatus=_S, o_totalprice=_D, o_orderdate=_T, o_orderpriority=_S
    ),
    "lineitem": _schema(
        l_orderkey=_L, l_partkey=_L, l_suppkey=_L, l_linenumber=_I, l_quantity=_D, l_extendedprice=_D,
        l_discount=_D, l_tax=_D, l_returnflag=_S, l_linestatus=_S, l_shipdate=_T,
    ),
    "events": _schema(event_id=_L, ts=_T, user_id=_L, event_type=_S, value=_D, props=_S),
    "documents": _schema(doc_id=_L, text=_S, lang=_S, source=_S, n_chars=_L),
    "embeddings": _schema(vec_id=_L, embedding=ArrayType(FloatType()), label=_I),
    "pages": _schema(page_id=_L, url=_S, html=_S),
    "labels": _schema(doc_id=_L, quality=_I, toxic=_I),
    "benchmark": _schema(item_id=_L, text=_S),
    "conversations": _schema(conv_id=_L, turn=_L, role=_S, text=_S),
}


def daily_schema(date: str, value: str, features: list[str]) -> StructType:
    """A daily table as stored: date text, one value to forecast, numeric features."""
    return StructType(
        [StructField(date, _S), StructField(value, _D)] + [StructField(f, _D) for f in features]
    )
