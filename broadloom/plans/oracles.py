"""SQL twins of the registered queries, for a check in another engine.

Written from the definitions, not from the Spark plans. ``_mix`` repeats ``functions.mixing`` in plain
64-bit arithmetic.
"""

from __future__ import annotations

from broadloom.plans import fixed
from broadloom.sources.generate import SEQUENCE_COLUMNS

P = 2147483647
ORACLES: dict[str, str] = {}
NUM = "l_quantity, l_extendedprice, l_discount, l_tax"
Y = "CASE WHEN l_returnflag = 'R' THEN 1 ELSE 0 END"
GAPPED = "(SELECT * REPLACE (nullif(l_discount, 0) AS l_discount) FROM lineitem)"


def d(x: float) -> str:
    """Double literal."""
    text = repr(float(x))
    return f"({text if 'e' in text else text + 'e0'})"


def dlist(values) -> str:
    return "[" + ", ".join(d(v) for v in values) + "]"


def r6(text: str) -> str:
    return f"round({text}, 6) + 0e0"


def r9(text: str) -> str:
    return f"round({text}, 9) + 0e0"


def _x(keys: list[str], seed: int) -> str:
    x = f"{(seed * 69069 + 1) % P}::BIGINT"
    for k in keys:
        x = f"(({x}) * 1103515245 + coalesce(({k})::BIGINT % {P}, 1540483477)) % {P}"
    return x


def _mix(source: str, keys: list[str], seed: int, columns: str = "*") -> str:
    """Subquery with column ``h`` = mix(keys, seed) added."""
    return (f"(SELECT * EXCLUDE (x0, x2), x2 * x2 % {P} * x0 % {P} AS h FROM (SELECT *, x0 * x0 % {P} AS x2 FROM "
            f"(SELECT {columns}, {_x(keys, seed)} AS x0 FROM {source})))")


def _cell(j: int | str) -> str:
    t = f"((h + {f'{j} * 998244353' if isinstance(j, str) else j * 998244353}) % {P})"
    return f"({t} * {t} % {P})"


def _uniform(j: int | str) -> str:
    return f"({_cell(j)} % 1000000)::DOUBLE / 1e6"


def _int(j: int, m: int) -> str:
    return f"({_cell(j)} % {m})::INTEGER"


def _gen(seed: int, columns: list[str]) -> str:
    rows = _mix("orders", ["o_orderkey"], seed, "o_orderkey AS id")
    return f"SELECT id, {', '.join(columns)} FROM {rows}"


def _wide(rule, dim: int, prefix: str = "f", first: int = 0) -> list[str]:
    return [f'{rule(first + i)} AS "{prefix}-{i}"' for i in range(dim)]


def _percent(j: int) -> str:
    return _int(j, 101)


def generators() -> None:
    tail = [f"{_int(16, 2)} AS output", f"{_int(17, 5)} AS input_1", f"{_int(18, 5)} AS input_2"]
    ORACLES["gen_classification"] = _gen(7, [*_wide(_uniform, 8), *_wide(_uniform, 8, "d", 8), *tail])
    ORACLES["gen_multitask_int"] = _gen(8, [*_wide(_percent, 8), *_wide(_percent, 8, "d", 8), *tail])
    ORACLES["gen_dense_int"] = _gen(9, [*_wide(_percent, 8), f"{_int(8, 2)} AS label"])
    drawn = _mix("range(8) t(j)", ["j"], 11, "j")  # the four columns with the smallest mixed number
    zero = f"(id % 3 <> 0 AND list_contains((SELECT list(j) FROM (SELECT j FROM {drawn} ORDER BY h LIMIT 4)), COLUMN))"
    ORACLES["gen_block_sparse"] = _gen(10, [
        *[f'CASE WHEN {zero.replace('COLUMN', str(i))} THEN 0e0 ELSE {_uniform(i)} END AS "f-{i}"' for i in range(8)],
        f"{_int(8, 2)} AS output"])
    ORACLES["gen_regression"] = _gen(11, [
        *_wide(_uniform, 8), f"{r6(f'100e0 + {_uniform(8)} * 100e0')} AS output", f"{_int(9, 5)} AS input_1",
        f"{_int(10, 5)} AS input_2"])
    ORACLES["gen_sequence_flat"] = _gen(12, [*_wide(_uniform, 16), f"{_uniform(16)} AS output"])
    out, steps = [], 200
    for i, c in enumerate(SEQUENCE_COLUMNS):
        total = f"list_sum([{_uniform('j')} FOR j IN range({i * steps}, {i * steps + steps})])"
        out += [f"{r6(total)} AS {c}_sum", f"{_uniform(i * steps)} AS {c}_first", f"{_uniform(i * steps + steps - 1)} AS {c}_last"]
    ORACLES["gen_sequence_vectors"] = _gen(13, [*out, f"{_int(len(SEQUENCE_COLUMNS) * steps, 2)}::DOUBLE AS label_per_client"])


def tables() -> None:
    ORACLES["csv_inferred_roundtrip"] = "SELECT o_orderkey, o_orderstatus, o_totalprice, o_orderpriority FROM orders"
    ORACLES["csv_schema_roundtrip"] = f"SELECT l_orderkey, l_partkey, {NUM}, {Y} AS label FROM lineitem"
    ORACLES["parquet_roundtrip"] = "SELECT event_id, user_id, event_type, value FROM events"
    ORACLES["project_columns"] = "SELECT l_orderkey, l_quantity, l_returnflag, l_linestatus FROM lineitem"
    ORACLES["positional_slice"] = f"SELECT {NUM} FROM lineitem"
    ORACLES["drop_column"] = "SELECT * EXCLUDE (o_orderdate) FROM orders"
    ORACLES["rename_label"] = "SELECT o_orderkey, o_totalprice AS label FROM orders"
    ORACLES["drop_null_rows"] = f"SELECT l_orderkey, {NUM}, l_linestatus FROM lineitem WHERE l_discount <> 0"
    ORACLES["repartition_counts"] = ("SELECT 10::BIGINT AS partitions, count(*) AS n_rows, true AS even FROM lineitem")
    ORACLES["row_count"] = "SELECT count(*) AS n_rows FROM lineitem"
    ORACLES["preview_rows"] = ("SELECT o_orderkey, o_totalprice, o_orderpriority FROM orders "
                               "ORDER BY o_orderkey LIMIT 5")
    ORACLES["random_split_partition"] = ("SELECT count(*) AS n_rows, 1::BIGINT AS max_copies, true AS near_weight "
                                         "FROM orders")
    h = _mix("orders", ["o_orderkey", "o_custkey"], 24, "o_orderkey, o_custkey")
    ORACLES["hash_split"] = (f"SELECT o_orderkey, o_custkey, CASE WHEN h % 1000000 < 700000 THEN 0 "
                             f"WHEN h % 1000000 < 900000 THEN 1 ELSE 2 END AS piece FROM {h}")


    h = _mix("(SELECT o_orderkey, nullif(o_custkey % 50, 0) AS k FROM orders)", ["o_orderkey", "k"], 24, "o_orderkey, k")
    ORACLES["hash_split_nulls"] = ORACLES["hash_split"].split(" FROM ")[0].replace("o_custkey", "k") + f" FROM {h}"


def feature_tables() -> None:
    def ranked(c: str) -> str:
        return (f"(SELECT {c}, (row_number() OVER (ORDER BY count(*) DESC, {c}) - 1)::DOUBLE AS i "
                f"FROM orders GROUP BY {c})")

    ORACLES["string_index"] = (
        f"SELECT o_orderkey, o.o_orderpriority, o.o_orderstatus, p.i AS priority_index, s.i AS status_index "
        f"FROM orders o JOIN {ranked('o_orderpriority')} p USING (o_orderpriority) "
        f"JOIN {ranked('o_orderstatus')} s USING (o_orderstatus)")
    parts = ("(SELECT l_partkey::VARCHAR AS part, (row_number() OVER (ORDER BY count(*) DESC, l_partkey::VARCHAR) "
             "- 1)::DOUBLE AS part_index FROM lineitem GROUP BY l_partkey)")
    ORACLES["string_index_join"] = (f"SELECT l_orderkey, l_partkey::VARCHAR AS part, part_index FROM lineitem l "
                                    f"JOIN {parts} p ON p.part = l.l_partkey::VARCHAR")
    ORACLES["assemble_vector"] = ("SELECT l_orderkey, l_quantity AS v0, l_extendedprice AS v1, l_discount AS v2, "
                                  "l_tax AS v3 FROM lineitem")
    ORACLES["assemble_keep_nan"] = ("SELECT l_orderkey, l_quantity AS v0, l_extendedprice AS v1, "
                                    "nullif(l_discount, 0) AS v2, l_tax AS v3 FROM lineitem")
    names = NUM.split(", ")
    moments = ", ".join(f"avg({c}) AS m{i}, stddev_samp({c}) AS s{i}" for i, c in enumerate(names))
    scaled = ", ".join(f"{r6(f'({c} - m{i}) / s{i}')} AS v{i}" for i, c in enumerate(names))
    train = _mix("lineitem", ["l_orderkey"], 24)
    ORACLES["standard_scale"] = (f"SELECT l_orderkey, {scaled} FROM lineitem CROSS JOIN (SELECT {moments} "
                                 f"FROM {train} WHERE h % 1000000 < 800000)")
    ORACLES["densify_vector"] = ("SELECT l_orderkey, true AS is_dense, l_discount AS v0, l_tax AS v1, "
                                 + ", ".join(f"0e0 AS v{i}" for i in range(2, 8)) + " FROM lineitem")
    e = [f"((c_nationkey * 5 + {3 * i}) % 7 - 3) / 4e0" for i in range(4)]
    ORACLES["embedding_lookup"] = ("SELECT c_custkey, " + ", ".join(f"{x} AS v{i}" for i, x in enumerate(e))
                                   + " FROM customer")
    ORACLES["concat_features"] = ("SELECT c_custkey, "
                                  + ", ".join(f"{x} AS v{i}" for i, x in enumerate([*e, "c_acctbal", *e]))
                                  + " FROM customer")


def sequence_tables() -> None:
    n = fixed.HISTORY
    kind = "list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)"
    steps = f"""
        recent AS (
            SELECT user_id, value, {kind}::DOUBLE AS kind, (hour(ts) + 1)::DOUBLE AS hour,
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back
            FROM events),
        kept AS (SELECT * FROM recent WHERE back <= {n}),
        users AS (SELECT user_id, count(*) AS n_steps FROM kept GROUP BY user_id),
        steps AS (
            SELECT u.user_id, u.n_steps, t.step::INTEGER AS step, coalesce(value, 0) AS value,
                   coalesce(kind, 0) AS kind, coalesce(hour, 0) AS hour, value IS NOT NULL AS real
            FROM users u CROSS JOIN range({n}) t(step)
            LEFT JOIN kept k ON k.user_id = u.user_id AND k.back = {n} - t.step)"""
    ORACLES["sequence_pad"] = f"WITH {steps} SELECT user_id, n_steps::INTEGER AS n_steps, step, value, kind FROM steps"
    ORACLES["sequence_pool"] = f"""WITH {steps} SELECT user_id,
        {r9('max(value)')} AS pooled0, {r9('max(kind)')} AS pooled1, {r9('avg(value)')} AS pooled2,
        {r9('avg(kind)')} AS pooled3, {r9('max(value) FILTER (real)')} AS masked0,
        {r9('avg(value) FILTER (real)')} AS masked1 FROM steps GROUP BY user_id"""
    parts = [*[f"((kind::BIGINT * 5 + {3 * i}) % 7 - 3) / 4e0" for i in range(3)],
             *[f"((hour::BIGINT * 5 + {3 * i}) % 7 - 3) / 4e0" for i in range(4)], "value"]
    ORACLES["sequence_embed"] = (f"WITH {steps} SELECT user_id, step, "
                                 + ", ".join(f"{p} AS v{i}" for i, p in enumerate(parts)) + " FROM steps")
    ORACLES["sequence_embed_pool"] = (
        f"WITH {steps} SELECT user_id, " + ", ".join(f"{r9(f'max({p})')} AS v{i}" for i, p in enumerate(parts))
        + ", " + ", ".join(f"{r9(f'avg({p})')} AS v{i + 8}" for i, p in enumerate(parts))
        + " FROM steps GROUP BY user_id")


def wide_sequences() -> None:
    n = fixed.WIDE_HISTORY
    ids = {"kind": "list_position(['click', 'error', 'purchase', 'signup', 'view'], event_type)", "hour": "hour(ts) + 1", "weekday": "dayofweek(ts) + 1",
           "day": "day(ts)", "minute": "minute(ts) + 1", "slot": "event_id % 499 + 1"}
    steps = f"""
        recent AS (SELECT user_id, value, {", ".join(f"{e} AS {c}" for c, e in ids.items())},
                   row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS back FROM events),
        kept AS (SELECT * FROM recent WHERE back <= {n}),
        steps AS MATERIALIZED (SELECT user_id, coalesce(value, 0) AS value, {", ".join(f"coalesce({c}, 0)::BIGINT AS {c}" for c in ids)}
                  FROM (SELECT DISTINCT user_id FROM kept) u CROSS JOIN range({n}) t(step)
                  LEFT JOIN kept k USING (user_id) WHERE k.back = {n} - t.step
                  UNION ALL SELECT user_id, 0, 0, 0, 0, 0, 0, 0 FROM (SELECT user_id, count(*) AS c FROM kept GROUP BY user_id), range({n}) p(i) WHERE i >= c)"""
    parts, first = [], 0
    for c, (_, width) in fixed.WIDE_EMBEDDINGS.items():
        parts.append(f"SELECT user_id, i + {first} AS position, (({c} * 5 + 3 * i) % 7 - 3) / 4e0 AS v, many FROM "
                     f"(SELECT user_id, {c}, count(*) AS many FROM steps GROUP BY ALL), range({width}) w(i)")
        first += width
    parts.append(f"SELECT user_id, {first}, value, 1 FROM steps")
    ORACLES["sequence_embed_wide"] = (f"WITH {steps} SELECT user_id, position::INTEGER AS position, {r9('max(v)')} AS most, {r9('sum(v * many) / sum(many)')} AS mean "
                                      f"FROM ({' UNION ALL '.join(parts)}) GROUP BY user_id, position")


def _pick(hist: str, lam: float, gamma: float, least: float, only: str = "") -> str:
    """Best split per node of a histogram (node, feature, bin, g, h)."""
    run = "OVER (PARTITION BY node, feature ORDER BY bin)"
    return f"""
        SELECT node, feature, bin, gain, gl, hl, g, h FROM (
            SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain::FLOAT DESC, feature, bin) AS rk FROM (
                SELECT *, 0.5e0 * (gl * gl / (hl + {d(lam)}) + (g - gl) * (g - gl) / (h - hl + {d(lam)})
                                   - g * g / (h + {d(lam)})) - {d(gamma)} AS gain
                FROM (SELECT node, feature, bin, sum(g) {run} AS gl, sum(h) {run} AS hl,
                             sum(g) OVER (PARTITION BY node, feature) AS g,
                             sum(h) OVER (PARTITION BY node, feature) AS h FROM {hist})
                WHERE hl >= {d(least)} AND h - hl >= {d(least)})
            WHERE gain > 1e-9) WHERE rk = 1"""


def _boost(label: str, options: dict, source: str = "lineitem", part: str = "0",
           cuts: list[list[float]] = fixed.BOOST_EDGES) -> tuple[str, str, str]:
    """Rounds of boosting unrolled: (WITH list, name of the node table, name of the last row table). Splits
    are chosen from the rows whose ``part`` is 0; every row is scored."""
    lam, eta, depth = options["reg_lambda"], options["eta"], options["max_depth"]
    bins = ", ".join("(" + " + ".join(f"({c} >= {d(e)})::INTEGER" for e in edges) + f") AS b{i}"
                     for i, (c, edges) in enumerate(zip(fixed.BOOST_FEATURES, cuts)))
    logistic = options["objective"] == "binary:logistic"
    ctes = [f"r0 AS MATERIALIZED (SELECT l_orderkey, l_quantity, {bins}, ({label})::DOUBLE AS y, 0e0 AS m, {part} AS part FROM {source})"]
    tables = []
    for t in range(options["num_round"]):
        w = f"CASE WHEN y = 1 THEN {d(options['pos_weight'])} ELSE 1e0 END"
        p = "(1e0 / (1e0 + exp(-m)))"
        g, h = (f"{w} * ({p} - y)", f"{w} * {p} * (1e0 - {p})") if logistic else (f"{w} * (m - y)", w)
        ctes.append(f"f{t} AS MATERIALIZED (SELECT *, {g} AS g, {h} AS h FROM r{t})")
        ctes.append(f"""n{t}_0 AS MATERIALIZED (SELECT *, 1 AS node, (SELECT -{d(eta)} * sum(g) / (sum(h) + {d(lam)})
            FROM f{t} WHERE part = 0) AS leaf FROM f{t})""")
        for level in range(depth):
            rows = f"n{t}_{level}"
            active = f"part = 0 AND node >= {2 ** level} AND node < {2 ** (level + 1)}"
            hist = " UNION ALL ".join(
                f"SELECT node, {i} AS feature, b{i} AS bin, sum(g) AS g, sum(h) AS h FROM {rows} WHERE {active} "
                f"GROUP BY node, b{i}" for i in range(len(fixed.BOOST_FEATURES)))
            best = _pick(f"({hist})", lam, options["gamma"], options["min_child_weight"])
            ctes.append(f"s{t}_{level} AS MATERIALIZED ({best})")
            value = "CASE s.feature " + " ".join(
                f"WHEN {i} THEN b{i}" for i in range(len(fixed.BOOST_FEATURES))) + " END"
            ctes.append(f"""n{t}_{level + 1} AS MATERIALIZED (
                SELECT n.* REPLACE (
                    CASE WHEN s.node IS NULL THEN n.node WHEN {value} <= s.bin THEN 2 * n.node
                         ELSE 2 * n.node + 1 END AS node,
                    CASE WHEN s.node IS NULL THEN n.leaf
                         WHEN {value} <= s.bin THEN -{d(eta)} * s.gl / (s.hl + {d(lam)})
                         ELSE -{d(eta)} * (s.g - s.gl) / (s.h - s.hl + {d(lam)}) END AS leaf)
                FROM {rows} n LEFT JOIN s{t}_{level} s ON n.node = s.node)""")
            tables.append(f"SELECT {t} AS tree, node, feature, bin, gain, NULL::DOUBLE AS leaf FROM s{t}_{level}")
        tables.append(f"SELECT DISTINCT {t} AS tree, node, NULL::INTEGER AS feature, NULL::INTEGER AS bin, "
                      f"NULL::DOUBLE AS gain, leaf FROM n{t}_{depth}")
        ctes.append(f"r{t + 1} AS MATERIALIZED (SELECT * EXCLUDE (g, h, node, leaf) REPLACE (m + leaf AS m) "
                    f"FROM n{t}_{depth})")
    ctes.append("tree_nodes AS MATERIALIZED (" + " UNION ALL ".join(tables) + ")")
    return "WITH " + ", ".join(ctes), "tree_nodes", f"r{options['num_round']}"


def boosting() -> None:
    for name, label, options in (("boost_stump_rounds", Y, fixed.CLASSIFY),
                                 ("boost_reg_rounds", "l_extendedprice / 1e3", fixed.REGRESS)):
        ctes, nodes, _ = _boost(label, options)
        ORACLES[name] = (f"{ctes} SELECT tree, node::INTEGER AS node, feature::INTEGER AS feature, "
                         f"bin::INTEGER AS bin, round(gain, 4) + 0e0 AS gain, {r6('leaf')} AS leaf FROM {nodes}")
    mostly_zero = ", ".join(f"CASE WHEN l_orderkey % 3 = 0 THEN {c} ELSE 0 END AS {c}" for c in fixed.BOOST_FEATURES[1:])
    ctes, nodes, _ = _boost(Y, fixed.CLASSIFY, source=f"(SELECT * REPLACE ({mostly_zero}) FROM lineitem)")
    ORACLES["boost_sparse_rounds"] = (f"{ctes} SELECT tree, node::INTEGER AS node, feature::INTEGER AS feature, "
                                      f"bin::INTEGER AS bin, round(gain, 4) + 0e0 AS gain, {r6('leaf')} AS leaf FROM {nodes}")
    ctes, nodes, rows = _boost(Y, fixed.CLASSIFY)
    p = "1e0 / (1e0 + exp(-m))"
    ORACLES["boost_score"] = (f"{ctes} SELECT l_orderkey, l_quantity, {r6('m')} AS margin, {r6(p)} AS probability, "
                              f"CASE WHEN {p} > 0.5 THEN 1e0 ELSE 0e0 END AS prediction FROM {rows}")
    ORACLES["boost_score_sql"] = ORACLES["boost_score"]
    every = [[float(i) for i in range(2, 51)], [i / 100 for i in range(1, 11)], [i / 100 for i in range(1, 9)]]
    more, nodes_of_all, _ = _boost(Y, fixed.CLASSIFY, cuts=every)
    cut = "CASE feature WHEN 0 THEN bin + 2 ELSE (bin + 1) / 100e0 END"
    ORACLES["boost_sketch_rounds"] = (f"{more} SELECT tree, node::INTEGER AS node, feature::INTEGER AS feature, round(({cut})::DOUBLE, 6) + 0e0 AS threshold, "
                                      f"round(gain, 4) AS gain, {r6('leaf')} AS leaf FROM {nodes_of_all}")
    valued = " UNION ALL ".join(f"SELECT {i} AS feature, {c} AS v, CASE WHEN l_returnflag = 'R' THEN 2e0 ELSE 1e0 END AS w FROM lineitem"
                                for i, c in enumerate(fixed.BOOST_FEATURES))
    run = (f"(SELECT feature, v, sum(sum(w)) OVER (PARTITION BY feature ORDER BY v) AS upto, sum(sum(w)) OVER (PARTITION BY feature) AS whole, "
           f"min(v) OVER (PARTITION BY feature) AS least FROM ({valued}) GROUP BY feature, v)")
    reached = f"(SELECT DISTINCT feature, min(v) AS v, any_value(least) AS least FROM {run}, range(1, 16) t(i) WHERE upto >= i * whole / 16 GROUP BY feature, i)"
    ORACLES["weighted_quantiles"] = (f"SELECT feature, (row_number() OVER (PARTITION BY feature ORDER BY v) - 1)::INTEGER AS position, {r6('v')} AS edge "
                                     f"FROM {reached} WHERE v > least")
    per = f"(SELECT feature, sum(gain) AS gain FROM {nodes} WHERE feature IS NOT NULL GROUP BY feature)"
    ORACLES["feature_importance"] = (f"{ctes} SELECT feature::INTEGER AS feature, {r6('gain')} AS gain, "
                                     f"{r6('gain / sum(gain) OVER ()')} AS importance FROM {per}")
    ORACLES["boost_split_counts"] = (f"{ctes} SELECT feature::INTEGER AS feature, count(*) AS splits FROM {nodes} "
                                     f"WHERE feature IS NOT NULL GROUP BY feature")
    bins = ("l_quantity", "round(l_discount * 100)", "round(l_tax * 100)")
    hist = " UNION ALL ".join(
        f"SELECT CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END AS node, {i} AS feature, ({b})::INTEGER AS bin, "
        f"sum(w * (0.5e0 - y)) AS g, sum(w * 0.25e0) AS h FROM (SELECT *, {Y} AS y, "
        f"CASE WHEN l_returnflag = 'R' THEN 2e0 ELSE 1e0 END AS w FROM lineitem) GROUP BY ALL"
        for i, b in enumerate(bins))
    ORACLES["best_split"] = ("SELECT node, feature, bin, " + ", ".join(f"{r6(c)} AS {c}" for c in ("gain", "gl", "hl", "g", "h"))
                             + f" FROM ({_pick(f'({hist})', 1.0, 0.1, 30.0)})")
    ORACLES["class_weight"] = (f"SELECT l_orderkey, {Y} AS y, CASE WHEN l_returnflag = 'R' THEN 2e0 ELSE 1e0 END "
                               f"AS weight FROM lineitem")


def _plan(table: str, key: str, size: int, columns: str) -> str:
    return (f"(SELECT {columns}, i AS row_index, i // {size} AS batch FROM (SELECT *, "
            f"row_number() OVER (ORDER BY {key}) - 1 AS i, count(*) OVER () AS n FROM {table}) "
            f"WHERE i // {size} < n // {size})")


def _adam(x: list[str], rounds: int, rate: float) -> str:
    """Full-batch Adam for inputs -> 2 relu units -> 1 sigmoid unit, from the fixed weights.

    ``k0`` holds parameters and moments as one row; each step adds the mean gradients and updates them.
    """
    w, b = fixed.weight, fixed.bias
    start = {f"u{i}{j}": w(i, j) for i in range(3) for j in range(2)} | {f"c{j}": b(j) for j in range(2)}
    start |= {f"o{j}": w(j, 0) for j in range(2)} | {"q0": b(0)}
    ctes = [f"t AS MATERIALIZED (SELECT {Y} AS y, " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(x)) + " FROM lineitem)",
            "k0 AS (SELECT " + ", ".join(f"{d(v)} AS {n}, 0e0 AS m_{n}, 0e0 AS v_{n}" for n, v in start.items()) + ")"]
    for s in range(1, rounds + 1):
        hidden = ", ".join(f"greatest(0e0, x0 * u0{j} + x1 * u1{j} + x2 * u2{j} + c{j}) AS a{j}" for j in range(2))
        rows = f"(SELECT *, 1e0 / (1e0 + exp(-(a0 * o0 + a1 * o1 + q0))) - y AS e FROM (SELECT *, {hidden} FROM t, k{s - 1}))"
        grad = {f"u{i}{j}": f"x{i} * CASE WHEN a{j} > 0 THEN e * o{j} ELSE 0e0 END" for i in range(3) for j in range(2)}
        grad |= {f"c{j}": f"CASE WHEN a{j} > 0 THEN e * o{j} ELSE 0e0 END" for j in range(2)}
        grad |= {f"o{j}": f"a{j} * e" for j in range(2)} | {"q0": "e"}
        ctes.append(f"g{s} AS MATERIALIZED (SELECT " + ", ".join(f"avg({v}) AS g_{n}" for n, v in grad.items()) + f" FROM {rows})")
        moved = ", ".join(f"{n}, 0.9e0 * m_{n} + 0.1e0 * g_{n} AS m_{n}, 0.999e0 * v_{n} + 0.001e0 * g_{n} * g_{n} AS v_{n}"
                          for n in start)
        ctes.append(f"k{s} AS MATERIALIZED (SELECT * REPLACE (" + ", ".join(
            f"{n} - {d(rate)} * (m_{n} / (1 - pow(0.9e0, {s}))) / (sqrt(v_{n} / (1 - pow(0.999e0, {s}))) + 1e-7) AS {n}"
            for n in start) + f") FROM (SELECT {moved} FROM k{s - 1}, g{s}))")
    names = {f"u{i}{j}": ("dense_1/weight", i * 2 + j) for i in range(3) for j in range(2)}
    names |= {f"c{j}": ("dense_1/bias", j) for j in range(2)} | {f"o{j}": ("output/weight", j) for j in range(2)}
    names["q0"] = ("output/bias", 0)
    return "WITH " + ", ".join(ctes) + " " + " UNION ALL ".join(
        f"SELECT '{n}' AS name, {i}::BIGINT AS position, round({c}, 7) AS value FROM k{rounds}"
        for c, (n, i) in names.items())


def _mini_batches(rate: float, rounds: int = 3) -> tuple[str, dict[str, str], list[str]]:
    """Adam over the batches of one epoch, inputs -> 2 relu units -> 1 sigmoid unit, from the fixed weights: (WITH list, the
    column of every parameter in ``k{rounds}``, the scored rows of every step before it is taken)."""
    w, b = fixed.weight, fixed.bias
    start = {f"u{i}{j}": w(i, j) for i in range(3) for j in range(2)} | {f"c{j}": b(j) for j in range(2)}
    start |= {f"o{j}": w(j, 0) for j in range(2)} | {"q0": b(0)}
    ctes = ["t AS MATERIALIZED (SELECT *, i // size AS batch FROM (SELECT (o_custkey % 100) / 100e0 AS x0, month(o_orderdate) / 12e0 AS x1, "
            "substr(o_orderpriority, 1, 1)::INTEGER / 5e0 AS x2, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS y, "
            f"row_number() OVER (ORDER BY o_orderkey) - 1 AS i, (count(*) OVER () + {rounds - 1}) // {rounds} AS size FROM orders))",
            "k0 AS (SELECT " + ", ".join(f"{d(v)} AS {n}, 0e0 AS m_{n}, 0e0 AS v_{n}" for n, v in start.items()) + ")"]
    scored = []
    for s in range(1, rounds + 1):
        hidden = ", ".join(f"greatest(0e0, x0 * u0{j} + x1 * u1{j} + x2 * u2{j} + c{j}) AS a{j}" for j in range(2))
        rows = f"(SELECT *, 1e0 / (1e0 + exp(-(a0 * o0 + a1 * o1 + q0))) AS p FROM (SELECT *, {hidden} FROM t, k{s - 1} WHERE batch = {s - 1}))"
        ctes.append(f"p{s} AS MATERIALIZED (SELECT *, p - y AS e FROM {rows})")
        scored.append(f"p{s}")
        grad = {f"u{i}{j}": f"x{i} * CASE WHEN a{j} > 0 THEN e * o{j} ELSE 0e0 END" for i in range(3) for j in range(2)}
        grad |= {f"c{j}": f"CASE WHEN a{j} > 0 THEN e * o{j} ELSE 0e0 END" for j in range(2)}
        grad |= {f"o{j}": f"a{j} * e" for j in range(2)} | {"q0": "e"}
        ctes.append(f"g{s} AS MATERIALIZED (SELECT " + ", ".join(f"sum({v}) / any_value(size) AS g_{n}" for n, v in grad.items()) + f" FROM p{s})")
        moved = ", ".join(f"{n}, 0.9e0 * m_{n} + 0.1e0 * g_{n} AS m_{n}, 0.999e0 * v_{n} + 0.001e0 * g_{n} * g_{n} AS v_{n}" for n in start)
        ctes.append(f"k{s} AS MATERIALIZED (SELECT * REPLACE (" + ", ".join(
            f"{n} - {d(rate)} * (m_{n} / (1 - pow(0.9e0, {s}))) / (sqrt(v_{n} / (1 - pow(0.999e0, {s}))) + 1e-7) AS {n}"
            for n in start) + f") FROM (SELECT {moved} FROM k{s - 1}, g{s}))")
    return "WITH " + ", ".join(ctes) + " ", {n: f"k{rounds}.{n}" for n in start}, scored


def training() -> None:
    ctes, columns, scored = _mini_batches(0.05)
    names = {f"u{i}{j}": ("dense_1/weight", i * 2 + j) for i in range(3) for j in range(2)}
    names |= {f"c{j}": ("dense_1/bias", j) for j in range(2)} | {f"o{j}": ("output/weight", j) for j in range(2)}
    names["q0"] = ("output/bias", 0)
    ORACLES["sync_steps"] = ctes + " UNION ALL ".join(
        f"SELECT '{n}' AS name, {i}::BIGINT AS position, round({columns[c]}, 7) AS value FROM k3" for c, (n, i) in names.items())
    seen = " UNION ALL ".join(f"SELECT {s + 1 + k} AS step, y, p FROM {t}" for s, t in enumerate(scored) for k in range(len(scored) - s))
    counted = (f"counted AS MATERIALIZED (SELECT step, count(*) AS n, avg(-(y * ln(p) + (1 - y) * ln(1 - p))) AS loss, "
               "count(*) FILTER (p > 0.5 AND y = 1) AS tp, count(*) FILTER (p <= 0.5 AND y = 0) AS tn, count(*) FILTER (p > 0.5 AND y = 0) AS fp, "
               f"count(*) FILTER (p <= 0.5 AND y = 1) AS fn FROM ({seen}) GROUP BY step)")
    bins = f"(SELECT step, least(floor(p * 200), 199) AS bin, sum(y) AS pos, sum(1 - y) AS neg FROM ({seen}) GROUP BY ALL)"
    ranked = f"(SELECT *, sum(neg) OVER (PARTITION BY step ORDER BY bin) - neg / 2e0 AS below FROM {bins})"
    area = f"area AS (SELECT step, CASE WHEN sum(pos) * sum(neg) = 0 THEN 0e0 ELSE sum(pos * below) / (sum(pos) * sum(neg)) END AS auc FROM {ranked} GROUP BY step)"
    rows = {"output_bce": "loss", "output_accuracy": "(tp + tn) / n", "output_precision": "CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END",
            "output_recall": "CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END", "output_auc": "auc", "output_tp": "tp", "output_tn": "tn",
            "output_fp": "fp", "output_fn": "fn", "rows": "n"}
    ORACLES["fit_log"] = ctes[:-1] + f", {counted}, {area} " + " UNION ALL ".join(
        f"SELECT 'fit' AS run, 0 AS epoch, step::BIGINT AS step, '{m}' AS metric, round(({e})::DOUBLE, 6) + 0e0 AS value FROM counted JOIN area USING (step)"
        for m, e in rows.items())


def steps() -> None:
    ORACLES["batch_plan"] = f"SELECT * FROM {_plan('orders', 'o_orderkey', 160, 'o_orderkey, o_totalprice')}"
    ORACLES["batch_plan_nulls"] = (
        "SELECT batch, count(*) AS n_rows, count(k) AS n_keys, min(i) AS first FROM (SELECT k, i, i // 160 AS batch, n FROM ("
        "SELECT k, row_number() OVER (ORDER BY k NULLS LAST) - 1 AS i, count(*) OVER () AS n FROM (SELECT CASE WHEN o_custkey % 50 <> 0 "
        "THEN o_orderkey END AS k FROM orders))) WHERE batch < n // 160 GROUP BY batch")
    ORACLES["trained_rows"] = (
        "SELECT run, epoch::INTEGER AS epoch, n_rows FROM (SELECT 'all' AS run, count(*) AS n_rows FROM orders UNION ALL "
        "SELECT 'whole', count(*) // 256 * 256 FROM orders), range(2) r(epoch)")
    ORACLES["piecewise_lr"] = (
        "SELECT o_orderkey, batch, CASE WHEN batch <= 20 THEN 1e-3 WHEN batch <= 40 THEN 1e-2 "
        f"WHEN batch <= 60 THEN 1e-4 ELSE 1e-3 END AS rate FROM {_plan('orders', 'o_orderkey', 160, 'o_orderkey')}")
    w, b = fixed.weight, fixed.bias
    x = ["ln(l_quantity + 1) / 4e0", "l_discount * 10e0", "l_tax * 10e0"]
    rows = f"(SELECT *, {Y} AS y, " + ", ".join(f"{e} AS x{i}" for i, e in enumerate(x)) + " FROM {src})"
    hidden = ", ".join(f"greatest(0e0, {' + '.join(f'x{i} * {d(w(i, j))}' for i in range(3))} + {d(b(j))}) AS a{j}"
                       for j in range(2))
    out = " + ".join(f"a{j} * {d(w(j, 0))}" for j in range(2)) + f" + {d(b(0))}"
    net = f"(SELECT *, 1e0 / (1e0 + exp(-({out}))) AS p FROM (SELECT *, {hidden} FROM {rows}))"
    grads = [("output/weight", j, f"a{j} * (p - y)") for j in range(2)] + [("output/bias", 0, "p - y")]
    for j in range(2):
        back = f"CASE WHEN a{j} > 0 THEN (p - y) * {d(w(j, 0))} ELSE 0e0 END"
        grads += [("dense_1/weight", i * 2 + j, f"x{i} * {back}") for i in range(3)] + [("dense_1/bias", j, back)]
    ORACLES["gradient_step"] = "WITH t AS MATERIALIZED (SELECT * FROM " + net.format(src="lineitem") + ") " + \
        " UNION ALL ".join(f"SELECT '{n}' AS name, {i}::BIGINT AS position, round(avg({e}), 7) AS value FROM t"
                           for n, i, e in grads)
    ORACLES["adam_steps"] = _adam(x, 2, 0.01)
    valid = _mix("lineitem", ["l_orderkey", "l_partkey"], 24)
    ORACLES["validation_metrics"] = (
        f"SELECT count(*) AS n_rows, {r6('avg(-(y * ln(p) + (1 - y) * ln(1 - p)))')} AS val_output_bce FROM "
        + net.format(src=f"(SELECT * FROM {valid} WHERE h % 1000000 >= 800000)"))
    i = "(pos - 1)"
    ORACLES["batch_norm_apply"] = (
        f"SELECT vec_id, {i}::INTEGER AS pos, "
        + r6(f"(v::DOUBLE - ({i} % 7 - 3) / 10e0) / sqrt(0.5e0 + {i} % 5 + 1e-3) * (1 + {i} % 3) + ({i} % 4 - 1)")
        + " AS v FROM (SELECT vec_id, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos FROM embeddings)")


def scores() -> None:
    z = "l_discount * 10e0 - l_tax * 5e0 - l_quantity / 50e0"
    rows = f"(SELECT *, {Y} AS y, 1e0 / (1e0 + exp(-({z}))) AS p, l_quantity * 1500e0 AS estimate FROM lineitem)"
    ORACLES["metric_bce"] = f"SELECT {r6('avg(-(y * ln(p) + (1 - y) * ln(1 - p)))')} AS bce FROM {rows}"
    gap = "(estimate - l_extendedprice)"
    ORACLES["metric_regression"] = (f"SELECT round(avg({gap} * {gap}), 2) AS mse, {r6(f'avg(abs({gap}))')} AS mae, "
                                    f"{r6(f'sqrt(avg({gap} * {gap}))')} AS rmse FROM {rows}")
    wrong = "avg(CASE WHEN (p > 0.5) = (y = 1) THEN 0e0 ELSE 1e0 END)"
    ORACLES["metric_classification"] = f"SELECT {r6(wrong)} AS error, {r6(f'1 - {wrong}')} AS accuracy FROM {rows}"
    parts = {"A": "(l_discount * 10e0 + 1)", "N": "(l_tax * 10e0 + 1)", "R": "(l_quantity / 50e0 + 1)"}
    chosen = "CASE l_returnflag " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in parts.items()) + " END"
    ORACLES["metric_sparse_ce"] = (f"SELECT {r6(f'avg(-ln({chosen} / ({' + '.join(parts.values())})))')} AS sparse_ce "
                                   f"FROM lineitem")
    pt = "(CASE WHEN y = 1 THEN p ELSE 1 - p END)"
    ORACLES["metric_focal"] = f"SELECT {r6(f'avg(-(1 - {pt}) * (1 - {pt}) * ln({pt}))')} AS focal FROM {rows}"
    counts = {"tp": "p > 0.5 AND y = 1", "tn": "p <= 0.5 AND y = 0", "fp": "p > 0.5 AND y = 0",
              "fn": "p <= 0.5 AND y = 1"}
    counted = ", ".join(f"count(*) FILTER ({v}) AS {k}" for k, v in counts.items())
    ORACLES["confusion_counts"] = f"SELECT {counted} FROM {rows}"
    ORACLES["precision_recall"] = (f"SELECT {r6('CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END')} AS precision, "
                                   f"{r6('CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END')} AS recall "
                                   f"FROM (SELECT {counted} FROM {rows})")

    def auc(score: str) -> str:
        """Mean rank of the positives (ties averaged) gives the pair-win share."""
        grouped = (f"(SELECT {score} AS s, count(*) FILTER (y = 1) AS pos, count(*) AS n FROM {rows} GROUP BY 1)")
        ranked = f"(SELECT pos, n, sum(n) OVER (ORDER BY s) - n + (n + 1) / 2e0 AS mean_rank FROM {grouped})"
        return (f"SELECT '{score}' AS score, {r6('(r - p1 * (p1 + 1) / 2e0) / (p1 * (n1 - p1))')} AS auc FROM "
                f"(SELECT sum(pos * mean_rank)::DOUBLE AS r, sum(pos)::DOUBLE AS p1, sum(n)::DOUBLE AS n1 FROM {ranked})")

    ORACLES["metric_auc"] = f"{auc('l_extendedprice')} UNION ALL {auc('estimate')}"
    err = "avg(pow(v::DOUBLE - (v::DOUBLE * 0.5e0 + 0.1e0), 2))"
    rows = (f"(SELECT vec_id, {err} AS e FROM (SELECT vec_id, unnest(embedding) AS v FROM embeddings) "
            f"GROUP BY vec_id)")
    ORACLES["reconstruction_error"] = f"SELECT {r6('avg(e)')} AS reconstruction_error FROM {rows}"
    ORACLES["reconstruction_rows"] = f"SELECT vec_id, {r6('e')} AS reconstruction_error FROM {rows}"


def _layer(source: str, given: list[str], width: int, units: int, relu: bool, name: str) -> str:
    """Add columns name0..name{units-1}: a dense layer with the fixed weights over ``given``."""
    out = []
    for j in range(units):
        z = " + ".join(f"{x} * {d(fixed.weight(i, j))}" for i, x in enumerate(given)) + f" + {d(fixed.bias(j))}"
        out.append(f"greatest(0e0, {z}) AS {name}{j}" if relu else f"{z} AS {name}{j}")
    return f"(SELECT *, {', '.join(out)} FROM {source})"


def networks() -> None:
    x = [f"embedding[{i + 1}]::DOUBLE" for i in range(64)]
    hidden = _layer("embeddings", x, 64, 4, True, "a")
    a = [f"a{i}" for i in range(4)]
    ORACLES["dense_forward"] = f"SELECT vec_id, {r6('y0')} AS y0, {r6('y1')} AS y1 FROM {_layer(hidden, a, 4, 2, False, 'y')}"
    one = _layer(hidden, a, 4, 1, False, "y")
    ORACLES["score_append"] = f"SELECT vec_id, label, {r6('y0')} AS prediction FROM {one}"
    ORACLES["score_full_batches"] = (f"SELECT vec_id, batch, {r6('y0')} AS prediction FROM "
                                     f"{_plan(one, 'vec_id', 160, 'vec_id, y0')}")
    ORACLES["score_roundtrip"] = f"SELECT vec_id, {r6('y0')} AS prediction FROM {one}"
    rows = "embeddings"
    for c, n in ((1, 5), (2, 3)):
        e = [f"(({'vec_id'} % {n} * 5 + {3 * k}) % 7 - 3) / 4e0" for k in range(4)]
        rows = _layer(rows, e, 4, 8, True, f"s{c}a")
        rows = _layer(rows, [f"s{c}a{i}" for i in range(8)], 8, 16, True, f"s{c}b")
    rows = _layer(rows, x, 64, 8, True, "ea")
    rows = _layer(rows, [f"ea{i}" for i in range(8)], 8, 6, True, "eb")
    code = [f"eb{i}" for i in range(6)]
    rows = _layer(rows, code, 6, 6, True, "da")
    rows = _layer(rows, [f"da{i}" for i in range(6)], 6, 8, True, "db")
    rows = _layer(rows, [f"db{i}" for i in range(8)], 8, 64, True, "dc")
    joined = [f"s1b{i}" for i in range(16)] + [f"s2b{i}" for i in range(16)] + code
    rows = _layer(rows, joined, 38, 5, True, "t")
    normed = [f"(t{i} / sqrt(1.001e0))" for i in range(5)]
    rows = _layer(rows, normed, 5, 2, False, "z")
    ORACLES["score_multi_output"] = (
        f"SELECT vec_id, {r6('1e0 / (1e0 + exp(z1 - z0))')} AS class0, {r6('1e0 / (1e0 + exp(z0 - z1))')} AS class1, "
        + ", ".join(f"{r6(f'dc{i}')} AS rebuilt{i}" for i in range(64))
        + f", {r6(' + '.join(f'dc{i}' for i in range(64)))} AS rebuilt_sum FROM {rows}")


def reports() -> None:
    ORACLES["regressor_roundtrip"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM lineitem"
    ORACLES["gbt_score_sql"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM lineitem"
    ORACLES["model_roundtrip"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM lineitem"
    ORACLES["params_roundtrip"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM orders"
    source = _mix("lineitem", ["l_orderkey"], 24)
    part = "CASE WHEN h % 1000000 < 800000 THEN 0 ELSE 1 END"
    fitted = []
    for depth in fixed.TRIAL_DEPTHS:
        for eta in fixed.TRIAL_RATES:
            ctes, _, _ = _boost(Y, fixed.TRIALS | {"num_round": max(fixed.TRIAL_ROUNDS), "max_depth": depth, "eta": eta, "objective": "binary:logistic"}, source, part)
            wrong = "avg(CASE WHEN (m > 0) = (y = 1) THEN 0e0 ELSE 1e0 END)"
            each = " UNION ALL ".join(f"SELECT {n} AS n_estimators, {wrong} AS error FROM r{n} WHERE part = 1" for n in fixed.TRIAL_ROUNDS)
            fitted.append(f"SELECT n_estimators, {depth} AS max_depth, {d(eta)} AS eta, error FROM ({ctes} {each})")
    rounds = ", ".join(f"({k}, {n})" for k, n in enumerate(fixed.TRIAL_ROUNDS))
    grid = f"(SELECT s * {len(fixed.TRIAL_ROUNDS)} + k AS trial, n_estimators FROM range(2) a(s), (VALUES {rounds}) g(k, n_estimators))"
    depths = f"(SELECT trial, {fixed.TRIAL_DEPTHS}[h % {len(fixed.TRIAL_DEPTHS)} + 1] AS max_depth, n_estimators FROM {_mix(grid, ['trial'], 3)})"
    rates = "[" + ", ".join(map(d, fixed.TRIAL_RATES)) + "]"
    drawn = f"(SELECT trial, n_estimators, max_depth, {rates}[h % {len(fixed.TRIAL_RATES)} + 1] AS eta FROM {_mix(depths, ['trial'], 4)})"
    trials = (f"SELECT trial::BIGINT AS trial, n_estimators::INTEGER AS n_estimators, max_depth::INTEGER AS max_depth, eta, {r6('error')} AS error "
              f"FROM {drawn} JOIN ({' UNION ALL '.join(fitted)}) USING (n_estimators, max_depth, eta)")
    ORACLES["search_trials"] = trials
    ORACLES["search_best"] = f"SELECT * FROM ({trials}) ORDER BY error, trial LIMIT 1"
    ORACLES["search_saved"] = "SELECT count(*) AS n_rows, 0::BIGINT AS n_different FROM lineitem"
    tried = []
    for n in (1, 2):
        for depth in (1, 2):
            ctes, _, rows = _boost("l_extendedprice / 1e3", fixed.SEARCH | {"num_round": n, "max_depth": depth,
                                   "reg_lambda": 1.0, "gamma": 0.1, "pos_weight": 1.0, "objective": "reg:squarederror"},
                                   source, part)
            tried.append(f"SELECT {n} AS n_estimators, {depth} AS max_depth, e AS rmse FROM "
                         f"({ctes} SELECT sqrt(avg((m - y) * (m - y))) AS e FROM {rows} WHERE part = 1)")
    grid = "(SELECT n - 1 AS trial, n AS n_estimators FROM (VALUES (1), (2)) g(n))"
    chosen = f"(SELECT trial, n_estimators, [1, 2][h % 2 + 1] AS max_depth FROM {_mix(grid, ['trial'], 3)})"
    ORACLES["search_hist"] = (f"SELECT trial::BIGINT AS trial, n_estimators, max_depth, {r6('rmse')} AS rmse "
                              f"FROM {chosen} JOIN ({' UNION ALL '.join(tried)}) USING (n_estimators, max_depth)")
    plan = _plan("events", "event_id", 100, "event_id, value")
    ORACLES["training_log"] = (f"SELECT 'run' AS run, 0 AS epoch, batch AS step, 'loss' AS metric, {r6('avg(value)')} "
                               f"AS value FROM {plan} WHERE batch % 10 = 0 GROUP BY batch")


for _part in (generators, tables, feature_tables, sequence_tables, wide_sequences, boosting, training, steps, scores, networks, reports):
    _part()
