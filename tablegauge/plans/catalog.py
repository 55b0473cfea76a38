"""Query catalogue: every operator as a named query over the driver's
tables, with the equivalent DuckDB SQL where the operator is expressible
in SQL.  ``__spark_entry__`` re-exports :data:`QUERIES` and :data:`ORACLE`.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablegauge.operators import audit as A
from tablegauge.operators import prepare as P
from tablegauge.operators import split as S
from tablegauge.operators import validate as V
from tablegauge.plans import inputs as I

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql
        return fn
    return deco


EH = f"({I.events_holes_sql()})"
_EV_TYPES = {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
             "event_type": "string", "value": "double", "props": "string"}
_EV_NUMERIC = {"event_id", "user_id", "value"}


def _miss_pred(c: str) -> str:
    return f"({c} IS NULL OR isnan({c}))" if _EV_TYPES[c] == "double" else f"({c} IS NULL)"


def _union(parts: list[str]) -> str:
    return "\nUNION ALL\n".join(parts)


# ============================================================ audit
@query("audit_shape", f"SELECT count(*) AS row_count, CAST(6 AS BIGINT) AS column_count FROM {EH} t")
def q_audit_shape(spark, sf):
    return A.audit_shape(I.events_holes(spark, sf))


_SQL_TYPES = ("CASE data_type WHEN 'BIGINT' THEN 'bigint' WHEN 'INTEGER' THEN 'int' "
              "WHEN 'DOUBLE' THEN 'double' WHEN 'VARCHAR' THEN 'string' "
              "WHEN 'TIMESTAMP' THEN 'timestamp_ntz' ELSE lower(data_type) END")


_MISSING_SQL = _union([
    f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_miss_pred(c)}) AS missing_count FROM {EH} t"
    for c in I.EVENTS_COLS])


@query("audit_columns",
       f"SELECT CAST(ordinal_position - 1 AS BIGINT) AS position, column_name, {_SQL_TYPES} AS data_type, "
       f"data_type IN ('BIGINT','INTEGER','DOUBLE','SMALLINT','TINYINT','FLOAT','HUGEINT') "
       f"OR data_type LIKE 'DECIMAL%' AS is_numeric, missing_count "
       f"FROM information_schema.columns JOIN ({_MISSING_SQL}) m USING (column_name) WHERE table_name = 'events'")
def q_audit_columns(spark, sf):
    """Each column's type with its missing values in the data."""
    df = I.events_holes(spark, sf)
    return A.audit_columns(df).join(A.audit_missing(df), "column_name") \
        .select("position", "column_name", "data_type", "is_numeric", "missing_count")


@query("audit_missing", _MISSING_SQL)
def q_audit_missing(spark, sf):
    return A.audit_missing(I.events_holes(spark, sf))


_DUP_COLS = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]


@query("audit_duplicates",
       "SELECT CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_row_count FROM "
       f"(SELECT count(*) AS n FROM lineitem GROUP BY {', '.join(_DUP_COLS)}) g")
def q_audit_duplicates(spark, sf):
    return A.audit_duplicates(I.table(spark, sf, "lineitem").select(*_DUP_COLS))


def _distinct_sql(c: str) -> str:
    return (f"SELECT '{c}' AS column_name, CAST(count(DISTINCT {c}) + "
            f"max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS BIGINT) AS distinct_count FROM {EH} t")


@query("audit_distinct", _union([_distinct_sql(c) for c in I.EVENTS_COLS]))
def q_audit_distinct(spark, sf):
    return A.audit_distinct(I.events_holes(spark, sf))


@query("audit_candidates",
       f"SELECT * FROM ({_union([_distinct_sql(c) for c in I.EVENTS_COLS])}) d "
       f"WHERE distinct_count > 1 AND distinct_count <= 20")
def q_audit_candidates(spark, sf):
    return A.audit_candidates(I.events_holes(spark, sf))


@query("audit_class_balance",
       "SELECT CAST(o_orderstatus AS VARCHAR) AS class_value, count(*) AS class_count, "
       "count(*) / sum(count(*)) OVER () AS class_proportion FROM orders GROUP BY 1")
def q_audit_class_balance(spark, sf):
    return A.audit_class_balance(I.table(spark, sf, "orders"), "o_orderstatus")


@query("audit_class_balance_nulls",
       f"SELECT CAST(event_type AS VARCHAR) AS class_value, count(*) AS class_count, "
       f"count(*) / sum(count(*)) OVER () AS class_proportion FROM {EH} t GROUP BY 1")
def q_audit_class_balance_nulls(spark, sf):
    return A.audit_class_balance(I.events_holes(spark, sf), "event_type")


@query("audit_target_values",
       "SELECT row_number() OVER (ORDER BY first_key) - 1 AS position, target_value, 'string' AS data_type FROM "
       "(SELECT o_orderpriority AS target_value, min(o_orderkey) AS first_key FROM orders GROUP BY 1) s")
def q_audit_target_values(spark, sf):
    """In first-seen order; the file holds the orders by ascending key."""
    return A.audit_target_values(I.table(spark, sf, "orders"), "o_orderpriority")


_EV_MISS_TOTAL = " + ".join(f"CAST({_miss_pred(c)} AS BIGINT)" for c in I.EVENTS_COLS)


def _constraints_sql() -> str:
    a = f"(SELECT count(*) AS n, sum({_EV_MISS_TOTAL}) AS miss FROM {EH} t) a"
    return _union([
        f"SELECT 'minimum_rows' AS constraint_name, '1000' AS required, CAST(n AS VARCHAR) AS actual, "
        f"n >= 1000 AS passed FROM {a}",
        "SELECT 'minimum_feature_columns', '8', '5', false",
        "SELECT 'has_numeric_columns', 'true', 'true', true",
        "SELECT 'has_non_numeric_columns', 'true', 'true', true",
        f"SELECT 'missing_values_present', '> 0', CAST(miss AS VARCHAR), miss > 0 FROM {a}",
    ])


@query("audit_constraints", _constraints_sql())
def q_audit_constraints(spark, sf):
    return A.audit_constraints(I.events_holes(spark, sf), "event_type")


def _report_sql() -> str:
    prof = [
        f"SELECT '{c}' AS column_name, count(*) FILTER (WHERE {_miss_pred(c)}) AS m, "
        f"count(DISTINCT {c}) + max(CASE WHEN {c} IS NULL THEN 1 ELSE 0 END) AS d FROM {EH} t"
        for c in I.EVENTS_COLS]
    parts = [
        f"SELECT 'shape' AS section, NULL::VARCHAR AS column_name, 'row_count' AS metric, "
        f"CAST(count(*) AS VARCHAR) AS value FROM {EH} t",
        "SELECT 'shape', NULL, 'column_count', '6'",
        f"SELECT 'shape', NULL, 'duplicate_row_count', CAST(coalesce(sum(n - 1), 0) AS VARCHAR) FROM "
        f"(SELECT count(*) AS n FROM {EH} t GROUP BY ALL_COLS) g".replace(
            "ALL_COLS", ", ".join(I.EVENTS_COLS)),
    ]
    for c in I.EVENTS_COLS:
        parts.append(f"SELECT 'columns', '{c}', 'data_type', '{_EV_TYPES[c]}'")
        parts.append(f"SELECT 'columns', '{c}', 'is_numeric', '{str(c in _EV_NUMERIC).lower()}'")
    for p in prof:
        parts.append(f"SELECT 'columns', column_name, 'missing_count', CAST(m AS VARCHAR) FROM ({p}) x")
        parts.append(f"SELECT 'columns', column_name, 'distinct_count', CAST(d AS VARCHAR) FROM ({p}) x")
        parts.append(f"SELECT 'columns', column_name, 'candidate_target', "
                     f"CASE WHEN d > 1 AND d <= 20 THEN 'true' ELSE 'false' END FROM ({p}) x")
    cons = _constraints_sql()
    for metric, expr in (("required", "required"), ("actual", "actual"),
                         ("passed", "CASE WHEN passed THEN 'true' ELSE 'false' END")):
        parts.append(f"SELECT 'constraints', constraint_name, '{metric}', {expr} FROM ({cons}) c")
    bal = (f"SELECT coalesce(CAST(event_type AS VARCHAR), '<null>') AS k, count(*) AS n, "
           f"count(*) / sum(count(*)) OVER () AS p FROM {EH} t GROUP BY 1")
    parts.append(f"SELECT 'target', k, 'class_count', CAST(n AS VARCHAR) FROM ({bal}) b")
    parts.append(f"SELECT 'target', k, 'class_proportion', printf('%.6f', p) FROM ({bal}) b")
    return _union(parts)


@query("audit_report", _report_sql())
def q_audit_report(spark, sf):
    return A.audit_report(I.events_holes(spark, sf), "event_type")


# ============================================================ validation
_LI_REQUIRED = ["l_orderkey", "l_linestatus", "l_quantity", "l_discount", "l_tax", "l_returnflag"]
_LI_RANGES = {"l_quantity": (1, 50), "l_discount": (0, 0.1), "l_tax": (0, 0.06)}
_LI_EXCLUDED = ["l_orderkey", "l_partkey", "l_suppkey"]
_LI_ALL = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice",
           "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate"]


def _rules_sql() -> str:
    def row(no, rule, col, observed, expected, passed, src="lineitem"):
        c = "NULL::VARCHAR" if col is None else f"'{col}'"
        return (f"SELECT CAST({no} AS BIGINT) AS rule_no, '{rule}' AS rule, {c} AS column_name, "
                f"CAST({observed} AS VARCHAR) AS observed, '{expected}' AS expected, {passed} AS passed "
                f"FROM {src}")
    parts = [row(1, "non_empty", None, "count(*)", ">= 1", "count(*) > 0")]
    for c in sorted(_LI_REQUIRED):
        parts.append(f"SELECT 2, 'required_columns', '{c}', 'present', 'present', true")
    parts.append(row(3, "target_column", "l_linestatus",
                     "'nulls=' || CAST(count(*) FILTER (WHERE l_linestatus IS NULL) AS VARCHAR) || "
                     "';invalid=' || CAST(count(*) FILTER (WHERE l_linestatus IS NOT NULL AND "
                     "l_linestatus NOT IN ('F','O')) AS VARCHAR)",
                     "nulls=0;invalid=0 of F,O",
                     "count(*) FILTER (WHERE l_linestatus IS NULL) = 0 AND count(*) FILTER (WHERE "
                     "l_linestatus IS NOT NULL AND l_linestatus NOT IN ('F','O')) = 0"))
    for c, (lo, hi) in _LI_RANGES.items():
        bad = f"count(*) FILTER (WHERE {c} < {lo} OR {c} > {hi})"
        parts.append(row(4, "numeric_ranges", c, bad, f"[{lo:g}, {hi:g}]", f"{bad} = 0"))
    d = "(count(DISTINCT l_linestatus) + max(CASE WHEN l_linestatus IS NULL THEN 1 ELSE 0 END))"
    parts.append(row(5, "expected_constants", "l_linestatus", d, "1", f"{d} = 1"))
    parts.append(
        "SELECT CAST(7 AS BIGINT), 'duplicate_rows', NULL, CAST(coalesce(sum(n - 1), 0) AS VARCHAR), "
        "'<= 0', coalesce(sum(n - 1), 0) <= 0 FROM (SELECT count(*) AS n FROM lineitem GROUP BY " + ", ".join(_LI_ALL) + ") g")
    parts.append(row(8, "minimum_rows", None, "count(*)", ">= 1000", "count(*) >= 1000"))
    parts.append("SELECT 9, 'usable_features', NULL, '7', '>= 8', false")
    return _union(parts)


@query("validate_rules", _rules_sql())
def q_validate_rules(spark, sf):
    li = I.table(spark, sf, "lineitem")
    return V.validate_dataset(li, target="l_linestatus", required_columns=_LI_REQUIRED,
                              excluded_columns=_LI_EXCLUDED, allowed_target_values=("F", "O"),
                              ranges=_LI_RANGES, constant_columns=["l_linestatus"], key_column=None,
                              max_duplicate_rows=0)


@query("validate_key_unique",
       "SELECT 'o_custkey' AS key_column, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count, "
       "coalesce(sum(n - 1), 0) = 0 AS passed FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) g")
def q_validate_key_unique(spark, sf):
    return V.key_duplicates(I.table(spark, sf, "orders"), "o_custkey")


@query("validate_key_unique_pass",
       "SELECT 'o_orderkey' AS key_column, CAST(coalesce(sum(n - 1), 0) AS BIGINT) AS duplicate_count, "
       "coalesce(sum(n - 1), 0) = 0 AS passed FROM (SELECT count(*) AS n FROM orders GROUP BY o_orderkey) g")
def q_validate_key_unique_pass(spark, sf):
    return V.key_duplicates(I.table(spark, sf, "orders"), "o_orderkey")


_ORD_ALL = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]


@query("validate_batch_schema", _union([
    "SELECT CAST(0 AS BIGINT) AS position, 'o_orderkey' AS expected_column, 'o_orderkey' AS actual_column, "
    "'ok' AS status",
    "SELECT 1, 'o_custkey', 'o_custkey', 'ok'",
    "SELECT 2, 'o_orderstatus', 'o_orderstatus', 'ok'",
    "SELECT 3, 'o_totalprice', 'o_totalprice', 'ok'",
    "SELECT 4, 'o_orderdate', 'o_orderdate', 'ok'",
    "SELECT 5, 'o_orderpriority', 'o_priority', 'missing'",
    "SELECT NULL, 'o_orderstatus', 'o_orderstatus', CASE WHEN count(*) FILTER (WHERE o_orderstatus IS NULL "
    "OR o_orderstatus NOT IN ('F', 'O')) = 0 THEN 'target_ok' ELSE 'target_invalid=' || CAST(count(*) FILTER "
    "(WHERE o_orderstatus IS NULL OR o_orderstatus NOT IN ('F', 'O')) AS VARCHAR) END FROM orders",
]))
def q_validate_batch_schema(spark, sf):
    """Schema of a batch with a renamed column against the expected order,
    then the target values of the batch (status 'P' is not allowed here)."""
    batch = I.table(spark, sf, "orders").withColumnRenamed("o_orderpriority", "o_priority")
    return V.check_batch_schema(batch, _ORD_ALL, target="o_orderstatus", allowed_target_values=("F", "O"))


@query("validate_predictions",
       "SELECT count(*) AS rows, CAST(0 AS BIGINT) AS bad_true, CAST(0 AS BIGINT) AS bad_pred, "
       "count(*) FILTER (WHERE p_pos IS NULL OR isnan(p_pos)) AS nan_proba, "
       "count(*) FILTER (WHERE p_pos < 0 OR p_pos > 1) AS out_of_range_proba, "
       "count(*) > 0 AND count(*) FILTER (WHERE p_pos IS NULL OR isnan(p_pos) OR p_pos < 0 OR p_pos > 1) = 0 "
       f"AS passed FROM ({I.lineitem_predictions_sql()}) p")
def q_validate_predictions(spark, sf):
    return V.validate_predictions(I.lineitem_predictions(spark, sf))


# ============================================================ preparation
_CUST = ["c_custkey", "c_name", "c_nationkey", "c_acctbal", "c_mktsegment"]


@query("drop_excluded", "SELECT c_nationkey, c_acctbal, c_mktsegment FROM customer")
def q_drop_excluded(spark, sf):
    return P.drop_excluded(I.table(spark, sf, "customer"), ["c_custkey", "c_name", "not_a_column"])


_CUST_TYPES = {"c_name": "categorical", "c_nationkey": "numeric", "c_acctbal": "numeric", "c_mktsegment": "categorical"}


@query("feature_types", _union([
    f"SELECT CAST({i} AS BIGINT) AS position, '{c}' AS column_name, '{t}' AS feature_type, "
    f"count(*) FILTER (WHERE {c} IS NULL) AS missing_count, count(DISTINCT {c}) AS distinct_count FROM customer"
    for i, (c, t) in enumerate(_CUST_TYPES.items())]))
def q_feature_types(spark, sf):
    """Each feature's kind with the missing and distinct values behind it."""
    cust = I.table(spark, sf, "customer")
    feats = P.feature_columns(cust, "c_custkey", [])
    counts = A.column_profile(cust.select(*feats)).select("column_name", "missing_count", "distinct_count")
    return P.feature_types_table(cust, feats).join(counts, "column_name") \
        .select("position", "column_name", "feature_type", "missing_count", "distinct_count")


_MISS_SEED = 42
_MISS_FRAC = 0.05


def _orders_missing(spark, sf, strategy, columns=None):
    o = I.orders_features(spark, sf)
    out, rep = P.inject_missing(o, keys=["o_orderkey"], fraction=_MISS_FRAC, seed=_MISS_SEED,
                                strategy=strategy, columns=columns, protected=["o_orderstatus"])
    return out, rep


_ALL_HOLES = {"o_custkey": "", "o_totalprice": "", "o_orderpriority": ""}
_SEL_HOLES = {"o_totalprice": "", "o_orderpriority": ""}
_OF = f"({I.orders_features_sql()})"


@query("missingness_all", I.missing_sql(_OF, I.ORDERS_COLS, ["o_orderkey"], _ALL_HOLES, _MISS_SEED, _MISS_FRAC))
def q_missingness_all(spark, sf):
    return _orders_missing(spark, sf, "all_eligible")[0]


@query("missingness_selected",
       I.missing_sql(_OF, I.ORDERS_COLS, ["o_orderkey"], _SEL_HOLES, _MISS_SEED, _MISS_FRAC))
def q_missingness_selected(spark, sf):
    return _orders_missing(spark, sf, "selected_columns", ["o_totalprice", "o_orderpriority"])[0]


_MA = f"({ORACLE['missingness_all']})"


@query("missingness_meta", _union([
    f"SELECT '{c}' AS column_name, (SELECT greatest(1, CAST(floor(count(*) * {_MISS_FRAC}) AS BIGINT)) "
    f"FROM orders) AS planned_cells, count(*) FILTER (WHERE {c} IS NULL) AS actual_missing FROM {_MA} t"
    for c in _ALL_HOLES]))
def q_missingness_meta(spark, sf):
    out, rep = _orders_missing(spark, sf, "all_eligible")
    aggs = [F.count_if(F.col(c).isNull()).alias(c) for c in rep.applied_columns]
    wide = out.agg(*aggs)
    return wide.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("column_name"), F.lit(rep.cells_per_column).cast("long").alias("planned_cells"),
                 F.col(c).alias("actual_missing")) for c in rep.applied_columns])))


def _impute_sql(kind: str) -> str:
    if kind == "median":
        fills = {c: f"(SELECT median({c}) FROM {_MA} t)" for c in ("o_custkey", "o_totalprice")}
    else:
        fills = {"o_orderpriority": f"(SELECT o_orderpriority FROM {_MA} t WHERE o_orderpriority IS NOT NULL "
                                    f"GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"}
    cols = []
    for c in I.ORDERS_COLS:
        if c in fills:
            cast = "VARCHAR" if c == "o_orderpriority" else "DOUBLE"
            cols.append(f"CAST(coalesce(CAST({c} AS {cast}), {fills[c]}) AS {cast}) AS {c}")
        else:
            cols.append(c)
    return f"SELECT {', '.join(cols)} FROM {_MA} t"


@query("impute_median", _impute_sql("median"))
def q_impute_median(spark, sf):
    df = q_missingness_all(spark, sf)
    return P.impute(df, P.column_medians(df, ["o_custkey", "o_totalprice"]))


@query("impute_mode", _impute_sql("mode"))
def q_impute_mode(spark, sf):
    df = q_missingness_all(spark, sf)
    return P.impute(df, P.column_modes(df, ["o_orderpriority"]))


# ============================================================ splits and samples
_SPLIT_SEED = 42
_TEST_SIZE = 0.2


def _hash_sql(seed, salt, key):
    return f"md5(concat_ws('|', '{seed}', '{salt}', CAST({key} AS VARCHAR)))"


def _split_sql(stratified: bool) -> str:
    h = _hash_sql(_SPLIT_SEED, "split", "o_orderkey")
    if not stratified:
        return (f"SELECT o_orderkey, o_orderstatus, CASE WHEN row_number() OVER (ORDER BY {h}) <= "
                f"(SELECT CAST(ceil({_TEST_SIZE} * count(*)) AS BIGINT) FROM orders) THEN 'test' "
                f"ELSE 'train' END AS part FROM orders")
    return f"""
WITH c AS (SELECT o_orderstatus AS s, count(*) AS n FROM orders GROUP BY 1),
t AS (SELECT CAST(ceil({_TEST_SIZE} * sum(n)) AS BIGINT) AS nt, CAST(sum(n) AS BIGINT) AS tot FROM c),
a AS (SELECT s, (nt * n) // tot AS fl, (nt * n) % tot AS rem, nt FROM c, t),
k AS (SELECT s, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, s) <= nt - sum(fl) OVER ()
                     THEN 1 ELSE 0 END AS k FROM a),
r AS (SELECT o_orderkey, o_orderstatus,
             row_number() OVER (PARTITION BY o_orderstatus ORDER BY {h}) AS rn FROM orders)
SELECT o_orderkey, o_orderstatus, CASE WHEN rn <= k THEN 'test' ELSE 'train' END AS part
FROM r JOIN k ON r.o_orderstatus = k.s"""


def _orders_split(spark, sf, stratified=True):
    o = I.table(spark, sf, "orders").select("o_orderkey", "o_orderstatus")
    return S.split_train_test(o, keys=["o_orderkey"], test_size=_TEST_SIZE, seed=_SPLIT_SEED,
                              target="o_orderstatus", stratify=stratified)


@query("split_stratified", _split_sql(True))
def q_split_stratified(spark, sf):
    return _orders_split(spark, sf, True)


@query("split_plain", _split_sql(False))
def q_split_plain(spark, sf):
    return _orders_split(spark, sf, False)


@query("split_distribution",
       f"SELECT part, CAST(o_orderstatus AS VARCHAR) AS class_value, count(*) AS n "
       f"FROM ({_split_sql(True)}) x GROUP BY 1, 2")
def q_split_distribution(spark, sf):
    return S.split_distribution(_orders_split(spark, sf, True), "o_orderstatus")


_BATCH = 300   # rows of a fixed-size batch
_GROWN = "(SELECT count(*) // 3 FROM orders)"   # batches that grow: a third of the orders


def _sample_sql(size=_BATCH) -> str:
    h = _hash_sql(_SPLIT_SEED, "sample", "o_orderkey")
    return (f"SELECT {', '.join(I.ORDERS_COLS)} FROM (SELECT *, row_number() OVER (ORDER BY {h}) AS rn "
            f"FROM ({I.orders_features_sql()}) o) x WHERE rn <= {size}")


def _placed_sql(rows: str, order: str) -> str:
    return f"SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS position FROM ({rows}) p"


_PERMUTED = _hash_sql(_SPLIT_SEED + 1, "permute", "o_orderkey")


@query("sample_n", _sample_sql())
def q_sample_n(spark, sf):
    return S.sample_rows(I.orders_features(spark, sf), keys=["o_orderkey"], n=_BATCH, seed=_SPLIT_SEED)


@query("stable_batch", _placed_sql(_sample_sql(), _PERMUTED))
def q_stable_batch(spark, sf):
    """The rows of the sample with their places in the seeded permutation."""
    ref = S.sample_rows(I.orders_features(spark, sf), keys=["o_orderkey"], n=_BATCH, seed=_SPLIT_SEED)
    return S.permute(ref, keys=["o_orderkey"], seed=_SPLIT_SEED + 1)


# ============================================================ encoding
@query("onehot_encode",
       "SELECT c_custkey, 'categorical__c_mktsegment_' || v AS feature_name, "
       "CAST(CASE WHEN c_mktsegment = v THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value "
       "FROM customer, (SELECT DISTINCT c_mktsegment AS v FROM customer) cats")
def q_onehot_encode(spark, sf):
    cust = I.table(spark, sf, "customer")
    return P.onehot_long(cust, P.fit_categories(cust, ["c_mktsegment"]), keep=["c_custkey"])


@query("onehot_unseen",
       "SELECT c_custkey, 'categorical__c_mktsegment_' || v AS feature_name, "
       "CAST(CASE WHEN c_mktsegment = v THEN 1.0 ELSE 0.0 END AS DOUBLE) AS value "
       "FROM customer, (SELECT DISTINCT c_mktsegment AS v FROM customer WHERE c_mktsegment < 'M') cats")
def q_onehot_unseen(spark, sf):
    cust = I.table(spark, sf, "customer")
    cats = P.fit_categories(cust.where(F.col("c_mktsegment") < "M"), ["c_mktsegment"])
    return P.onehot_long(cust, cats, keep=["c_custkey"])


_FM_NUM = ["c_acctbal", "c_nationkey"]
_FM_CAT = ["c_mktsegment"]


@query("onehot_names",
       "SELECT CAST(0 AS BIGINT) AS position, 'numeric__c_acctbal' AS feature_name UNION ALL "
       "SELECT 1, 'numeric__c_nationkey' UNION ALL "
       "SELECT 1 + row_number() OVER (ORDER BY v), 'categorical__c_mktsegment_' || v "
       "FROM (SELECT DISTINCT c_mktsegment AS v FROM customer) c")
def q_onehot_names(spark, sf):
    cust = I.table(spark, sf, "customer")
    spec = P.fit_features(cust, _FM_NUM, _FM_CAT, keep=["c_custkey"])
    return spec.names(spark)


@query("feature_matrix",
       "SELECT c_custkey, 'numeric__c_acctbal' AS feature_name, c_acctbal AS value FROM customer UNION ALL "
       "SELECT c_custkey, 'numeric__c_nationkey', CAST(c_nationkey AS DOUBLE) FROM customer UNION ALL "
       "SELECT c_custkey, 'categorical__c_mktsegment_' || v, CASE WHEN c_mktsegment = v THEN 1.0 ELSE 0.0 END "
       "FROM customer, (SELECT DISTINCT c_mktsegment AS v FROM customer) cats")
def q_feature_matrix(spark, sf):
    cust = I.table(spark, sf, "customer")
    spec = P.fit_features(cust, _FM_NUM, _FM_CAT, keep=["c_custkey"])
    return P.features_long(spec.transform(cust), spec.names(spark), ["c_custkey"])


# ============================================================ evaluation (M1–M7, G1)
_PD = f"({I.lineitem_predictions_sql('discount')})"
_PE = f"({I.lineitem_predictions_sql('price')})"


def _counts_sql(src):
    return (f"SELECT count(*) AS n, "
            f"count(*) FILTER (WHERE y_true = 'Yes' AND y_pred = 'Yes') AS tp, "
            f"count(*) FILTER (WHERE y_true = 'No' AND y_pred = 'Yes') AS fp, "
            f"count(*) FILTER (WHERE y_true = 'Yes' AND y_pred = 'No') AS fn, "
            f"count(*) FILTER (WHERE y_true = 'No' AND y_pred = 'No') AS tn FROM {src} p")


def _auc_sql(src):
    return (f"SELECT CAST(sum(2 * pos * nb + pos * neg) AS DOUBLE) / (2.0 * sum(pos) * sum(neg)) AS roc_auc "
            f"FROM (SELECT s, pos, neg, coalesce(sum(neg) OVER (ORDER BY s ROWS BETWEEN UNBOUNDED PRECEDING "
            f"AND 1 PRECEDING), 0) AS nb FROM (SELECT p_pos AS s, "
            f"CAST(sum(CASE WHEN y_true = 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS pos, "
            f"CAST(sum(CASE WHEN y_true <> 'Yes' THEN 1 ELSE 0 END) AS BIGINT) AS neg FROM {src} p GROUP BY 1) c) w")


def _metrics_sql(src):
    return (f"SELECT (tp + tn) / n AS accuracy, "
            f"(coalesce(tp / nullif(tp + fn, 0), 0) + coalesce(tn / nullif(tn + fp, 0), 0)) / "
            f"nullif((CASE WHEN tp + fn > 0 THEN 1 ELSE 0 END) + (CASE WHEN tn + fp > 0 THEN 1 ELSE 0 END), 0) "
            f"AS balanced_accuracy, "
            f"coalesce(tp / nullif(tp + fp, 0), 0) AS precision_pos, "
            f"coalesce(tp / nullif(tp + fn, 0), 0) AS recall_pos, "
            f"coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0) AS f1_pos, "
            f"({_auc_sql(src)}) AS roc_auc FROM ({_counts_sql(src)}) c")


@query("metrics_all", _metrics_sql(_PD))
def q_metrics_all(spark, sf):
    from tablegauge.operators import evaluate as E
    return E.classification_metrics(I.lineitem_predictions(spark, sf, "discount"))


@query("roc_auc", _auc_sql(_PE))
def q_roc_auc(spark, sf):
    from tablegauge.operators import evaluate as E
    return E.roc_auc(I.lineitem_predictions(spark, sf, "price")).select("roc_auc")


@query("confusion_matrix",
       "SELECT a AS actual, b AS predicted, count(p.y_true) AS n FROM (VALUES ('No'), ('Yes')) x(a) "
       "CROSS JOIN (VALUES ('No'), ('Yes')) y(b) "
       f"LEFT JOIN {_PD} p ON p.y_true = a AND p.y_pred = b GROUP BY 1, 2")
def q_confusion_matrix(spark, sf):
    from tablegauge.operators import evaluate as E
    return E.confusion_matrix(I.lineitem_predictions(spark, sf, "discount"))


_GATE = {"f1_pos": 0.30, "roc_auc": 0.50, "accuracy": 0.95}


@query("quality_gate", _union([
    f"SELECT '{m}' AS metric, {m} AS value, CAST({t} AS DOUBLE) AS minimum_required, coalesce({m} >= {t}, false) AS passed, "
    f"{'true' if m == 'f1_pos' else 'false'} AS is_primary FROM ({_metrics_sql(_PD)}) m"
    for m, t in _GATE.items()]))
def q_quality_gate(spark, sf):
    from tablegauge.operators import evaluate as E
    mets = E.classification_metrics(I.lineitem_predictions(spark, sf, "discount"))
    return E.quality_gate(mets, _GATE, primary="f1_pos")


@query("gate_summary",
       f"SELECT bool_and(passed) AS passed, 'f1_pos' AS primary_metric, "
       f"max(value) FILTER (WHERE is_primary) AS primary_value, "
       f"string_agg(metric, ',' ORDER BY metric) FILTER (WHERE NOT passed) AS failed_metrics FROM "
       f"({_union([f'''SELECT '{m}' AS metric, {m} AS value, coalesce({m} >= {t}, false) AS passed, {'true' if m == 'f1_pos' else 'false'} AS is_primary FROM ({_metrics_sql(_PD)}) m''' for m, t in _GATE.items()])}) g")
def q_gate_summary(spark, sf):
    from tablegauge.operators import evaluate as E
    return E.gate_summary(q_quality_gate(spark, sf))


# ============================================================ drift
from tablegauge.functions.stats import chi2_sf_sql, ks_pvalue_sql  # noqa: E402
from tablegauge.operators import drift as D  # noqa: E402

_ORD_TARGET = "o_orderstatus"
# Simulated drift on orders: price scaled and clipped, customer key shifted
# by a half (exercises half-to-even rounding of integer columns), priority
# set to one value.
_ORD_DRIFT = {
    "o_totalprice": {"kind": "numeric", "transform": "scale", "magnitude": 0.75,
                     "clip_min": 1000, "clip_max": 300000},
    "o_custkey": {"kind": "numeric", "transform": "add", "magnitude": 50.5, "clip_min": 0, "clip_max": 1499},
    "o_orderpriority": {"kind": "categorical", "transform": "set_constant", "value": "1-URGENT"},
}
_ORD_FEATURES = ["o_custkey", "o_totalprice", "o_orderpriority"]


def _orders_batches(spark, sf, size=None):
    """Batches of a third of all orders, or of ``size`` rows."""
    orders = I.orders_features(spark, sf)
    return D.monitoring_batches(orders, keys=["o_orderkey"], size=orders.count() // 3 if size is None else size,
                                seed=_SPLIT_SEED, settings=_ORD_DRIFT, target=_ORD_TARGET)


def _drifted_sql(src: str | None = None) -> str:
    return (f"SELECT o_orderkey, CAST(round_even(CASE WHEN o_custkey IS NULL THEN NULL ELSE "
            f"least(1499.0, greatest(0.0, CAST(o_custkey AS DOUBLE) + 50.5)) END, 0) AS BIGINT) AS o_custkey, "
            f"o_orderstatus, CASE WHEN o_totalprice IS NULL THEN NULL ELSE "
            f"least(300000.0, greatest(1000.0, o_totalprice * 0.75)) END AS o_totalprice, "
            f"'1-URGENT' AS o_orderpriority FROM ({src or _sample_sql()}) s")


def _batches_sql(size=_BATCH) -> str:
    sample = _sample_sql(size)
    return _union([f"SELECT *, 'reference' AS batch FROM ({_placed_sql(sample, 'o_orderkey')}) r",
                   f"SELECT *, 'stable' AS batch FROM ({_placed_sql(sample, _PERMUTED)}) s",
                   f"SELECT *, 'drifted' AS batch FROM ({_placed_sql(_drifted_sql(sample), _PERMUTED)}) d"])


@query("drift_batches", _batches_sql())
def q_drift_batches(spark, sf):
    return _orders_batches(spark, sf, _BATCH).union()


_ALL_DRIFTED = _drifted_sql(I.orders_features_sql())


def _all_drifted(spark, sf):
    """The drift transforms over all orders."""
    return D.apply_drift(I.orders_features(spark, sf), _ORD_DRIFT, _ORD_TARGET)


@query("drift_transform", _ALL_DRIFTED)
def q_drift_transform(spark, sf):
    return _all_drifted(spark, sf)


@query("drift_target_unchanged",
       f"SELECT count(*) AS mismatched_rows FROM ("
       f"(SELECT o_orderkey, o_orderstatus FROM orders EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM ({_ALL_DRIFTED}) b) UNION ALL "
       f"(SELECT o_orderkey, o_orderstatus FROM ({_ALL_DRIFTED}) b EXCEPT ALL SELECT o_orderkey, o_orderstatus FROM orders)) x")
def q_drift_target_unchanged(spark, sf):
    return D.target_mismatches(I.orders_features(spark, sf), _all_drifted(spark, sf), ["o_orderkey"], _ORD_TARGET)


_SPLIT_TS = "2024-01-16 00:00:00"
_EV_NUM = ["value", "user_id"]


def _event_halves(spark, sf):
    ev = I.events_holes(spark, sf)
    cut = F.expr(f"TIMESTAMP_NTZ '{_SPLIT_TS}'")
    return ev.where(F.col("ts") < cut), ev.where(F.col("ts") >= cut)


def _obs_sql(features, as_type):
    side = f"CASE WHEN ts < TIMESTAMP '{_SPLIT_TS}' THEN 0 ELSE 1 END"
    return _union([f"SELECT '{c}' AS feature, CAST({c} AS {as_type}) AS v, {side} AS side FROM {EH} e "
                   f"WHERE {c} IS NOT NULL" for c in features])


def _ks_sql(obs: str | None = None) -> str:
    obs = obs or _obs_sql(_EV_NUM, 'DOUBLE')
    return f"""
WITH c AS (SELECT feature, v, CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS nr,
                  CAST(sum(side) AS BIGINT) AS nc FROM ({obs}) o GROUP BY 1, 2),
t AS (SELECT feature, CAST(sum(nr) AS BIGINT) AS n_ref, CAST(sum(nc) AS BIGINT) AS n_cur FROM c GROUP BY 1),
w AS (SELECT c.feature, CAST(sum(nr) OVER (PARTITION BY c.feature ORDER BY v) AS BIGINT) AS cr,
             CAST(sum(nc) OVER (PARTITION BY c.feature ORDER BY v) AS BIGINT) AS cc, n_ref, n_cur
      FROM c JOIN t ON c.feature = t.feature),
d AS (SELECT feature, CAST(max(abs(cr * n_cur - cc * n_ref)) AS DOUBLE) / CAST(n_ref * n_cur AS DOUBLE) AS statistic,
             n_ref, n_cur FROM w GROUP BY feature, n_ref, n_cur)
SELECT feature, statistic, round({ks_pvalue_sql('statistic', 'n_ref', 'n_cur')}, 9) AS p_value, n_ref, n_cur
FROM d"""


@query("drift_ks", _ks_sql())
def q_drift_ks(spark, sf):
    ref, cur = _event_halves(spark, sf)
    return D.ks_scores(ref, cur, _EV_NUM, exact_small=False).withColumn("p_value", F.round("p_value", 9))


def _chi2_sql(obs: str | None = None) -> str:
    obs = obs or _obs_sql(['event_type'], 'VARCHAR')
    e_r = "(n_ref * (nr + nc) / (n_ref + n_cur))"
    e_c = "(n_cur * (nr + nc) / (n_ref + n_cur))"
    return f"""
WITH c AS (SELECT feature, v, CAST(sum(CASE WHEN side = 0 THEN 1 ELSE 0 END) AS BIGINT) AS nr,
                  CAST(sum(side) AS BIGINT) AS nc FROM ({obs}) o GROUP BY 1, 2),
t AS (SELECT feature, CAST(sum(nr) AS BIGINT) AS n_ref, CAST(sum(nc) AS BIGINT) AS n_cur, count(*) AS categories
      FROM c GROUP BY 1)
SELECT c.feature, round(sum(power(nr - {e_r}, 2) / {e_r} + power(nc - {e_c}, 2) / {e_c}), 9) AS statistic,
       CAST(categories - 1 AS BIGINT) AS dof, categories, n_ref, n_cur
FROM c JOIN t ON c.feature = t.feature GROUP BY c.feature, categories, n_ref, n_cur"""


@query("drift_chi2", _chi2_sql())
def q_drift_chi2(spark, sf):
    ref, cur = _event_halves(spark, sf)
    return D.chi2_statistics(ref, cur, ["event_type"]).withColumn("statistic", F.round("statistic", 9))


_LI_CATEGORIES = ["l_returnflag", "l_linestatus", "l_linenumber", "l_quantity"]


def _lineitem_categories_sql() -> str:
    obs = _union([f"SELECT '{c}' AS feature, CAST({c} AS VARCHAR) AS v, CAST(l_orderkey % 2 AS INTEGER) AS side FROM lineitem"
                  for c in _LI_CATEGORIES])
    return (f"SELECT feature, statistic, round({chi2_sf_sql('statistic', 'dof')}, 8) AS p_value, dof "
            f"FROM ({_chi2_sql(obs)}) s")


@query("drift_chi2_scores", _lineitem_categories_sql())
def q_drift_chi2_scores(spark, sf):
    """Chi-square p-values of all line items, orders of even against odd
    keys: categories with odd and with even degrees of freedom."""
    li = I.table(spark, sf, "lineitem")
    even = F.col("l_orderkey") % 2 == 0
    return D.chi2_scores(li.where(even), li.where(~even), _LI_CATEGORIES) \
        .select("feature", F.round("statistic", 9).alias("statistic"), F.round("p_value", 8).alias("p_value"), "dof")


_FEAT_THR = 0.5
_SHARE_THR = 0.15


def _features_sql() -> str:
    pos = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position"
                             for i, c in enumerate(_EV_NUM))
    return (f"SELECT f.feature, f.position, coalesce(k.p_value, 1.0) AS score, "
            f"coalesce(k.p_value, 1.0) < {_FEAT_THR} AS drifted FROM ({pos}) f "
            f"LEFT JOIN ({_ks_sql()}) k ON f.feature = k.feature")


def _event_features(spark, sf):
    ref, cur = _event_halves(spark, sf)
    scores = D.ks_scores(ref, cur, _EV_NUM, exact_small=False).select("feature", F.round("p_value", 9).alias("score"))
    return D.drifted_features(scores, _EV_NUM, _FEAT_THR)


@query("drift_features", _features_sql())
def q_drift_features(spark, sf):
    return _event_features(spark, sf)


def _gate_sql(src: str | None = None) -> str:
    return (f"SELECT count(*) AS evaluated_feature_count, CAST(count(*) FILTER (WHERE drifted) AS BIGINT) "
            f"AS drifted_feature_count, coalesce(count(*) FILTER (WHERE drifted) / count(*), 0.0) "
            f"AS drifted_feature_share, coalesce(count(*) FILTER (WHERE drifted) / count(*), 0.0) >= {_SHARE_THR} "
            f"AS dataset_drift, CASE WHEN coalesce(count(*) FILTER (WHERE drifted) / count(*), 0.0) >= "
            f"{_SHARE_THR} THEN 'failed' ELSE 'passed' END AS gate_status FROM ({src or _features_sql()}) f")


@query("drift_gate", _gate_sql())
def q_drift_gate(spark, sf):
    return D.drift_gate(_event_features(spark, sf), _SHARE_THR)


def _summary_sql(src: str) -> str:
    return (f"SELECT g.*, (SELECT coalesce(string_agg(feature, ',' ORDER BY position) FILTER (WHERE drifted), '') "
            f"FROM ({src}) f) AS drifted_feature_names, CAST({_SHARE_THR} AS DOUBLE) AS configured_threshold, "
            f"CAST({_FEAT_THR} AS DOUBLE) AS feature_threshold FROM ({_gate_sql(src)}) g")


@query("drift_summary", _summary_sql(_features_sql()))
def q_drift_summary(spark, sf):
    return D.drift_summary(_event_features(spark, sf), feature_threshold=_FEAT_THR, share_threshold=_SHARE_THR)


def _orders_compare(spark, sf, current: str):
    from tablegauge.plans.monitoring import run_monitoring
    orders = I.orders_features(spark, sf)
    res = run_monitoring(orders, keys=["o_orderkey"], target=_ORD_TARGET, size=orders.count() // 3,
                         seed=_SPLIT_SEED, settings=_ORD_DRIFT, current=current, excluded=["o_orderkey"],
                         feature_threshold=_FEAT_THR, share_threshold=_SHARE_THR,
                         allowed_target_values=["F", "O", "P"])
    return res.features, res.summary


# ============================================================ run history and ranking
from tablegauge.operators import rank as RK  # noqa: E402
from tablegauge.sources import runs_store as RS  # noqa: E402


def _runs_from_part(spark, sf, fallback: bool = False) -> DataFrame:
    """A run history derived from ``part``: one run per part, name = brand,
    algorithm = type, gate status from the size (NULL for some), metrics as
    text with some non-numeric values."""
    p = I.table(spark, sf, "part")
    status = (F.when(F.col("p_size") >= 10, "failed") if fallback else
              F.when(F.col("p_size") >= 30, "passed").when(F.col("p_size") >= 10, "failed"))
    return p.select(
        F.concat(F.lit("run-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("run_id"),
        F.col("p_brand").alias("run_name"),
        F.col("p_type").alias("model_algorithm"),
        status.alias("quality_gate_status"),
        F.when(F.col("p_name").like("%bolt%"), F.lit("n/a")).otherwise(F.col("p_size").cast("string"))
        .alias("f1_pos"),
        (F.col("p_retailprice") / 2000.0).alias("balanced_accuracy"),
        F.when(F.col("p_type") == "SMALL", F.lit(None)).otherwise(F.col("p_retailprice") / 3000.0)
        .alias("roc_auc"),
        (F.col("p_partkey").cast("double") / 10000.0).alias("precision_pos"),
        F.lit(0.5).alias("recall_pos"),
        F.lit(0.75).alias("accuracy"),
        F.create_map(F.lit("model.class_weight"), F.when(F.col("p_size") % 2 == 0, F.lit("balanced")),
                     F.lit("model.max_iter"), F.lit("1000"),
                     F.lit("split.test_size"), F.lit("0.2"),
                     F.lit("split.stratify"), F.lit("true")).alias("params"))


def _runs_sql(fallback: bool = False) -> str:
    status = ("CASE WHEN p_size >= 10 THEN 'failed' END" if fallback else
              "CASE WHEN p_size >= 30 THEN 'passed' WHEN p_size >= 10 THEN 'failed' END")
    return (f"SELECT 'run-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS run_id, p_brand AS run_name, "
            f"p_type AS model_algorithm, {status} AS quality_gate_status, "
            f"CASE WHEN p_name LIKE '%bolt%' THEN NULL ELSE CAST(p_size AS DOUBLE) END AS metric_f1, "
            f"p_retailprice / 2000.0 AS metric_balanced_accuracy, "
            f"CASE WHEN p_type = 'SMALL' THEN NULL ELSE p_retailprice / 3000.0 END AS metric_roc_auc, "
            f"CAST(p_partkey AS DOUBLE) / 10000.0 AS metric_precision, CAST(0.5 AS DOUBLE) AS metric_recall, "
            f"CAST(0.75 AS DOUBLE) AS metric_accuracy, "
            f"CASE WHEN p_size % 2 = 0 THEN 'balanced' END AS param_model_class_weight, "
            f"'1000' AS param_model_max_iter, '0.2' AS param_split_test_size, 'true' AS param_split_stratify, "
            f"coalesce({status}, 'failed') = 'passed' AS eligible FROM part")


_RANK_KEYS = ("metric_f1 DESC NULLS LAST, metric_balanced_accuracy DESC NULLS LAST, "
              "metric_roc_auc DESC NULLS LAST, metric_precision DESC NULLS LAST, metric_recall DESC NULLS LAST, "
              "metric_accuracy DESC NULLS LAST, coalesce(run_name, '') ASC, coalesce(run_id, '') ASC")
_RANK_COLS = ("run_id, run_name, model_algorithm, quality_gate_status, metric_f1, metric_balanced_accuracy, "
              "metric_roc_auc, metric_precision, metric_recall, metric_accuracy, eligible")


def _ranked_sql(fallback: bool = False) -> str:
    r = f"({_runs_sql(fallback)})"
    return (f"SELECT CAST(row_number() OVER (ORDER BY {_RANK_KEYS}) AS BIGINT) AS rank, {_RANK_COLS} "
            f"FROM {r} r WHERE eligible OR NOT (SELECT bool_or(eligible) FROM {r} x)")


def _ranked(spark, sf, fallback=False):
    r = RK.rank_runs(_runs_from_part(spark, sf, fallback))
    return r.select("rank", *[c.strip() for c in _RANK_COLS.split(",")])


@query("rank_runs", _ranked_sql(False))
def q_rank_runs(spark, sf):
    return _ranked(spark, sf, False)


@query("rank_runs_fallback", _ranked_sql(True))
def q_rank_runs_fallback(spark, sf):
    return _ranked(spark, sf, True)


@query("best_run", f"SELECT * EXCLUDE (rank) FROM ({_ranked_sql(False)}) x WHERE rank = 1")
def q_best_run(spark, sf):
    b = RK.best_run(_runs_from_part(spark, sf))
    return b.select(*[c.strip() for c in _RANK_COLS.split(",")])


_CMP_SQL_COLS = ("rank, run_id, run_name, model_algorithm, quality_gate_status, metric_f1 AS f1_pos, "
                 "metric_balanced_accuracy AS balanced_accuracy, metric_roc_auc AS roc_auc, "
                 "metric_precision AS precision_pos, metric_recall AS recall_pos, metric_accuracy AS accuracy, "
                 "eligible, param_model_class_weight, param_model_max_iter, param_split_test_size, "
                 "param_split_stratify")


@query("compare_runs",
       f"SELECT {_CMP_SQL_COLS} FROM (SELECT CAST(row_number() OVER (ORDER BY {_RANK_KEYS}) AS BIGINT) AS rank, * "
       f"FROM ({_runs_sql()}) r WHERE eligible OR NOT (SELECT bool_or(eligible) FROM ({_runs_sql()}) x)) y")
def q_compare_runs(spark, sf):
    return RK.flatten_parameters(RK.comparison_rows(RK.rank_runs(_runs_from_part(spark, sf))))


@query("runs_append_scan",
       "SELECT 'run-' || lpad(CAST(p_partkey AS VARCHAR), 8, '0') AS run_id, p_brand AS run_name, "
       "CASE WHEN p_size >= 30 THEN 'passed' ELSE 'failed' END AS quality_gate_status, "
       "p_type AS model_algorithm, CAST(p_size AS DOUBLE) AS f1_pos, p_retailprice / 2000.0 AS roc_auc "
       "FROM part WHERE p_size >= 25")
def q_runs_append_scan(spark, sf):
    """Append runs of two experiments to a partitioned table in the shared
    scratch folder, then scan one experiment back (partition pruning)."""
    from tablegauge.session import scratch_path
    p = I.table(spark, sf, "part")
    runs = p.select(
        F.concat(F.lit("run-"), F.lpad(F.col("p_partkey").cast("string"), 8, "0")).alias("run_id"),
        F.col("p_brand").alias("run_name"),
        F.to_timestamp(F.lit("2024-01-01 00:00:00")).alias("start_time"),
        F.lit("FINISHED").alias("status"),
        F.create_map(F.lit("f1_pos"), F.col("p_size").cast("double"),
                     F.lit("roc_auc"), F.col("p_retailprice") / 2000.0).alias("metrics"),
        F.create_map(F.lit("model.algorithm"), F.col("p_type")).alias("params"),
        F.create_map(F.lit("quality_gate.status"),
                     F.when(F.col("p_size") >= 30, "passed").otherwise("failed")).alias("tags"),
        F.when(F.col("p_size") >= 25, "exp-b").otherwise("exp-a").alias("experiment"))
    path = scratch_path(spark, "runs")
    RS.append_runs(runs.where(F.col("experiment") == "exp-a"), path)
    RS.append_runs(runs.where(F.col("experiment") == "exp-b"), path)
    scanned = RS.load_runs(spark, path, "exp-b")
    return scanned.select("run_id", "run_name", "quality_gate_status", "model_algorithm", "f1_pos", "roc_auc")


# ============================================================ file round trips
@query("csv_scan",
       "SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 7 = 0 THEN NULL ELSE o_totalprice END AS o_totalprice, "
       "CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders")
def q_csv_scan(spark, sf):
    """All orders through a CSV file with missing markers in a numeric and a text column."""
    from tablegauge.session import scratch_path
    from tablegauge.sources.files import read_table, write_table
    marked = I.table(spark, sf, "orders").select(
        "o_orderkey", "o_custkey", F.when(F.col("o_orderkey") % 7 == 0, "NA").otherwise(F.col("o_totalprice").cast("string")).alias("o_totalprice"),
        F.when(F.col("o_orderkey") % 11 == 0, "n/a").otherwise(F.col("o_orderstatus")).alias("o_orderstatus"))
    path = write_table(marked, scratch_path(spark, "orders.csv"), fmt="csv")
    return read_table(spark, path, fmt="csv")


@query("split_many_strata",
       "WITH h AS (SELECT o_orderkey, CAST(o_orderkey // 8 AS VARCHAR) AS s, md5(concat_ws('|', '42', 'pick', CAST(o_orderkey AS VARCHAR))) AS m FROM orders) "
       "SELECT o_orderkey, row_number() OVER (PARTITION BY s ORDER BY m) <= 1 AS picked FROM h")
def q_split_many_strata(spark, sf):
    """One row of each of very many strata, which grow with the table."""
    from tablegauge.functions.columns import row_hash
    from tablegauge.functions.hashrank import select_smallest
    df = I.table(spark, sf, "orders").select("o_orderkey")
    out = select_smallest(df, row_hash(42, "pick", ["o_orderkey"]), lambda sizes: sizes.select("s", F.lit(1).alias("k")),
                          F.expr("o_orderkey div 8"), flag="picked")
    return out.select("o_orderkey", "picked")


@query("batch_roundtrip", _batches_sql(_GROWN))
def q_batch_roundtrip(spark, sf):
    """The batches written in their orders and read back with the places of the rows in the files."""
    from tablegauge.session import scratch_path
    from tablegauge.sources.files import read_table, write_in_order
    b = _orders_batches(spark, sf)
    root = scratch_path(spark, "batches")
    out = None
    for name, frame in b.placed.items():
        path = write_in_order(frame, f"{root}/{name}.csv", position_col=b.position, fmt="csv")
        back = read_table(spark, path, fmt="csv", schema=b.reference.schema, position_col=b.position).withColumn("batch", F.lit(name))
        out = back if out is None else out.unionByName(back)
    return out


@query("json_roundtrip", ORACLE["audit_constraints"])
def q_json_roundtrip(spark, sf):
    from tablegauge.session import scratch_path
    from tablegauge.sources.files import write_report
    rep = A.audit_constraints(I.events_holes(spark, sf), "event_type")
    path = write_report(rep, scratch_path(spark, "constraints.json"))
    return spark.read.json(path).select("constraint_name", "required", "actual", "passed")


# ============================================================ training
from tablegauge.operators import fits as FT  # noqa: E402
from tablegauge.operators import train as TR  # noqa: E402
from tablegauge.plans import training as TP  # noqa: E402


def _labelled_docs(spark, sf) -> DataFrame:
    """labels joined with documents: target ``quality`` (0/1), features
    ``n_chars`` (numeric), ``lang`` and ``source`` (categorical)."""
    lab = I.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("string").alias("quality"))
    docs = I.table(spark, sf, "documents").select("doc_id", "n_chars", "lang", "source")
    return lab.join(docs, "doc_id")


@query("class_weights",
       "SELECT CAST(quality AS VARCHAR) AS class_value, count(*) AS n, "
       "sum(count(*)) OVER () / (count(*) OVER () * count(*)) AS weight FROM labels GROUP BY 1")
def q_class_weights(spark, sf):
    lab = I.table(spark, sf, "labels").select(F.col("quality").cast("double").alias("label"))
    w = TR.class_weight_map(lab, "label", "balanced")
    counts = lab.groupBy("label").agg(F.count(F.lit(1)).alias("n"))
    m = F.create_map(*[x for k, v in w.items() for x in (F.lit(k), F.lit(v))])
    return counts.select(F.col("label").cast("int").cast("string").alias("class_value"), "n",
                         m[F.col("label")].alias("weight"))


_DRAW_TREES = 10
_U = f"CAST('0x' || substr({_hash_sql(42, 'draw', 'tree').replace('CAST(tree AS VARCHAR)', 'CAST(tree AS VARCHAR), CAST(doc_id AS VARCHAR)')}, 1, {FT.DRAW_BITS // 4}) AS BIGINT)"


@query("subsample_weights", f"""
WITH d AS (SELECT CAST(tree AS INTEGER) AS tree, CAST(quality AS DOUBLE) AS label, {_U} AS u FROM labels, range({_DRAW_TREES}) r(tree)),
n AS (SELECT tree, label, CAST(sum({" + ".join(f"(u >= {c})::INT" for c in FT.poisson_cuts())}) AS BIGINT) AS n FROM d GROUP BY 1, 2)
SELECT tree, label, n, sum(n) OVER (PARTITION BY tree) / (count(*) OVER (PARTITION BY tree) * n) AS weight FROM n WHERE n > 0""")
def q_subsample_weights(spark, sf):
    return FT.draw_weights(I.table(spark, sf, "labels").select("doc_id", F.col("quality").cast("double").alias("label")),
                           "label", ["doc_id"], 42, _DRAW_TREES)


def _train_cfg(spec: TR.ModelSpec, name: str) -> TP.TrainingConfig:
    return TP.TrainingConfig(target="quality", keys=["doc_id"], positive="1", negative="0", model=spec,
                             test_size=0.2, split_seed=42, stratify=True, seed=42, missing_enabled=True,
                             missing_fraction=0.05, missing_seed=42, missing_strategy="all_eligible",
                             thresholds={"f1_pos": 0.45, "roc_auc": 0.45}, primary="f1_pos",
                             experiment="docs-quality", run_name=name,
                             validation={"allowed_target_values": ("0", "1"), "key_column": "doc_id",
                                         "required_columns": ["doc_id", "quality"], "min_rows": 10,
                                         "min_features": 3},
                             dataset_path="labels+documents")


_SPECS = {
    "01_logreg_balanced": TR.ModelSpec("logistic_regression", "balanced", 200, {"C": 1.0}),
    "02_logreg_c05": TR.ModelSpec("logistic_regression", "balanced", 200, {"C": 0.5}),
    "03_logreg_unweighted": TR.ModelSpec("logistic_regression", None, 200, {"C": 1.5}),
    "04_forest_balanced": TR.ModelSpec("random_forest", "balanced", None,
                                       {"n_estimators": 50, "max_depth": 8, "min_samples_leaf": 2}),
    "05_gbt": TR.ModelSpec("gradient_boosting", None, None,
                           {"n_estimators": 30, "learning_rate": 0.05, "subsample": 0.9}),
    "06_forest_subsample": TR.ModelSpec("random_forest", "balanced_subsample", None, {"n_estimators": 8, "max_depth": 6}),
}


def _train(spark, sf, name):
    """The test part's keys and true labels, and what must hold of its predictions for any fit."""
    p = TP.train_run(_labelled_docs(spark, sf), _train_cfg(_SPECS[name], name), enforce=False).predictions
    return p.select("doc_id", "y_true", F.col("p_pos").between(0.0, 1.0).alias("is_probability"),
                    F.col("y_pred").isin("0", "1").alias("is_class"),
                    ((F.col("y_pred") == "1") == (F.col("p_pos") > 0.5)).alias("class_agrees"))


_TRAIN_SQL = f"""
WITH d AS (SELECT doc_id, CAST(quality AS VARCHAR) AS y_true FROM labels JOIN documents USING (doc_id)),
c AS (SELECT y_true, count(*) AS n FROM d GROUP BY 1),
t AS (SELECT CAST(ceil({_TEST_SIZE} * sum(n)) AS BIGINT) AS nt, CAST(sum(n) AS BIGINT) AS tot FROM c),
a AS (SELECT y_true, (nt * n) // tot AS fl, (nt * n) % tot AS rem, nt FROM c, t),
k AS (SELECT y_true, fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, y_true) <= nt - sum(fl) OVER () THEN 1 ELSE 0 END AS k FROM a),
r AS (SELECT doc_id, y_true, row_number() OVER (PARTITION BY y_true ORDER BY {_hash_sql(42, "split", "doc_id")}) AS rn FROM d)
SELECT doc_id, y_true, true AS is_probability, true AS is_class, true AS class_agrees FROM r JOIN k USING (y_true) WHERE rn <= k"""


@query("train_logreg", _TRAIN_SQL)
def q_train_logreg(spark, sf):
    return _train(spark, sf, "01_logreg_balanced")


@query("train_forest", _TRAIN_SQL)
def q_train_forest(spark, sf):
    return _train(spark, sf, "04_forest_balanced")


@query("train_gbt", _TRAIN_SQL)
def q_train_gbt(spark, sf):
    return _train(spark, sf, "05_gbt")


@query("experiment_sweep")
def q_experiment_sweep(spark, sf):
    cfgs = {n: _train_cfg(s, n) for n, s in _SPECS.items()}
    cfgs["07_bad_weights"] = _train_cfg(TR.ModelSpec("random_forest", "no such weights", None, {}), "07_bad_weights")
    return TP.sweep(_labelled_docs(spark, sf), cfgs).drop("run_id", "metrics")     # a run id is new each time


# ============================================================ orders monitoring batches: scores
def _batch_obs_sql(features, as_type, current: str | None = None) -> str:
    """Observations of the reference (side 0) and the current (side 1, drifted by default) orders batch."""
    parts = []
    sample = _sample_sql(_GROWN)
    for side, src in ((0, sample), (1, current or _drifted_sql(sample))):
        for c in features:
            parts.append(f"SELECT '{c}' AS feature, CAST({c} AS {as_type}) AS v, {side} AS side "
                         f"FROM ({src}) b WHERE {c} IS NOT NULL")
    return _union(parts)


_ORD_NUM = ["o_custkey", "o_totalprice"]


@query("drift_orders_ks", _ks_sql(_batch_obs_sql(_ORD_NUM, "DOUBLE")))
def q_drift_orders_ks(spark, sf):
    """KS of the numeric features, reference vs drifted orders batch."""
    b = _orders_batches(spark, sf)
    return D.ks_scores(b.reference, b.drifted, _ORD_NUM).withColumn("p_value", F.round("p_value", 9))


@query("drift_orders_chi2", _chi2_sql(_batch_obs_sql(["o_orderpriority", "o_orderstatus"], "VARCHAR")))
def q_drift_orders_chi2(spark, sf):
    """Chi-square statistic and degrees of freedom, reference vs drifted
    orders batch: the set-to-constant priority and the untouched status."""
    b = _orders_batches(spark, sf)
    return D.chi2_statistics(b.reference, b.drifted, ["o_orderpriority", "o_orderstatus"]) \
        .withColumn("statistic", F.round("statistic", 9))


def _orders_features_sql(current: str) -> str:
    """Scores of the drift features and the untouched ones of an orders batch."""
    names = [c for c in I.ORDERS_COLS if c not in ("o_orderkey", _ORD_TARGET)]
    pos = " UNION ALL ".join(f"SELECT '{c}' AS feature, CAST({i} AS BIGINT) AS position" for i, c in enumerate(names))
    cat = [c for c in names if c not in _ORD_NUM]
    tail = chi2_sf_sql("statistic", "dof")
    scores = (f"SELECT feature, p_value FROM ({_ks_sql(_batch_obs_sql(_ORD_NUM, 'DOUBLE', current))}) a UNION ALL "
              f"SELECT feature, {tail} AS p_value FROM ({_chi2_sql(_batch_obs_sql(cat, 'VARCHAR', current))}) b")
    return (f"SELECT f.feature, f.position, coalesce(k.p_value, 1.0) AS score, coalesce(k.p_value, 1.0) < {_FEAT_THR} AS drifted "
            f"FROM ({pos}) f LEFT JOIN ({scores}) k ON f.feature = k.feature")


@query("drift_orders_drifted", _summary_sql(_orders_features_sql(_drifted_sql(_sample_sql(_GROWN)))))
def q_drift_orders_drifted(spark, sf):
    """Reference vs drifted orders batch, KS and chi-square."""
    return _orders_compare(spark, sf, "drifted")[1]


@query("drift_orders_stable", _summary_sql(_orders_features_sql(_sample_sql(_GROWN))))
def q_drift_orders_stable(spark, sf):
    """Reference vs its own permutation: nothing drifts."""
    return _orders_compare(spark, sf, "stable")[1]


# ============================================================ streaming drift monitor
def _stream_sql() -> str:
    sample = _sample_sql(_GROWN)
    return _union([
        f"SELECT CAST({i} AS INTEGER) AS batch_id, {_GROWN} AS current_rows, evaluated_feature_count, drifted_feature_count, "
        f"gate_status, drifted_feature_names FROM ({_summary_sql(_orders_features_sql(src))}) s"
        for i, src in enumerate((sample, _drifted_sql(sample)))])


@query("drift_stream", _stream_sql())
def q_drift_stream(spark, sf):
    """The stable and the drifted orders batch land as equally many files in
    a folder; the streaming monitor takes one batch's files at a time and
    compares them with the reference batch."""
    from tablegauge.session import scratch_path
    from tablegauge.streaming import run_drift_monitor_once
    b = _orders_batches(spark, sf)
    files = 1 + b.reference.count() // 1_000_000
    folder = scratch_path(spark, "incoming")
    for frame in (b.stable, b.drifted):
        frame.repartition(files).write.mode("append").parquet(folder)
    out = run_drift_monitor_once(spark, b.reference, folder, schema=b.reference.schema, features=_ORD_FEATURES,
                                 max_files_per_trigger=files, feature_threshold=_FEAT_THR, share_threshold=_SHARE_THR)
    return out.select("batch_id", "current_rows", "evaluated_feature_count", "drifted_feature_count",
                      "gate_status", "drifted_feature_names")
