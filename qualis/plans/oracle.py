"""Oracle SQL (DuckDB) for the registered queries.

The views ``lineitem orders customer nation region part`` are pre-registered;
every query rebuilds the dirty fixture as CTEs from them and states the audit
semantics in plain SQL (window ranks instead of the engine's block sequences,
``NOT EXISTS`` instead of marker joins, ranked records instead of the engine's
closed-form repair evaluation). Shared with the engine: only the rule values
and the literal rule/message texts.
"""

from __future__ import annotations

from qualis.plans import sqlfn as S
from qualis.rules import MANDATORY_SALES, PRIMARY_KEY, TABLES, UNIQUE_KEYS, Rules, fmt_g
from qualis.sources import fixture as FX

Q = S.q


def _ref(table: str) -> str:
    if table == "targets":
        return "COALESCE(month, 'nan') || '/' || COALESCE(region, 'nan')"
    return f"COALESCE({PRIMARY_KEY[table]}, 'row:' || CAST(_row_id AS VARCHAR))"


def fixture_ctes(clean: bool = False, extended: bool = False) -> list[str]:
    cols = FX.sales_columns(extended)
    x = lambda text: text if extended else ""
    twice = ", ".join(str(n) for n in [41, 42] + (FX.EXTRA_DOUBLED if extended else []))
    nulls = lambda cs: ", ".join(f"NULLIF({c}, '') AS {c}" for c in cs)
    iso = "strftime(d, '%Y-%m-%d')"
    v = lambda c: f"CAST({c} AS VARCHAR)"
    slot = "-1" if clean else "(l.l_orderkey * 31 + l.l_partkey * 17 + l.l_suppkey * 7 + l.l_linenumber) % 1000"
    bad = "false" if clean else "true"
    return [
        f"""li AS (SELECT l.l_orderkey, l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_discount,
            l.l_returnflag, CAST(l.l_shipdate AS DATE) AS d, o.o_custkey, r.r_name, p.p_retailprice,
            {slot} AS slot
          FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
          JOIN customer c ON o.o_custkey = c.c_custkey JOIN nation n ON c.c_nationkey = n.n_nationkey
          JOIN region r ON n.n_regionkey = r.r_regionkey JOIN part p ON l.l_partkey = p.p_partkey)""",
        f"""li2 AS (SELECT *, 0 AS copy_no FROM li UNION ALL SELECT *, 1 AS copy_no FROM li WHERE slot IN ({twice}))""",
        f"""sales_txt AS (SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, copy_no,
          CASE WHEN slot = 40 THEN '' ELSE 'S-' || {v('l_orderkey')} || '-' || {v('l_linenumber')} || '-'
               || {v('l_partkey')} || '-' || {v('l_suppkey')} END AS sale_id,
          CASE WHEN slot IN (0, 31) THEN strftime(d, '%d.%m.%Y') WHEN slot = 1 THEN strftime(d, '%Y/%m/%d')
               WHEN slot = 2 THEN strftime(d, '%d-%m-%Y') WHEN slot = 3 THEN ' ' || {iso}
               WHEN slot = 4 THEN '' WHEN slot = 5 THEN 'garbage' WHEN slot = 6 THEN '2030-06-15'
               WHEN slot = 7 THEN '1990-02-30' ELSE {iso} END AS sale_date,
          CASE WHEN slot IN (8, 32) THEN '' WHEN slot = 9 THEN 'C-' || {v('o_custkey + 90000000')}
               ELSE 'C-' || {v('o_custkey')} END AS customer_id,
          CASE WHEN slot = 10 THEN '' WHEN slot = 11 THEN 'P-' || {v('l_partkey + 90000000')}
               ELSE 'P-' || {v('l_partkey')} END AS product_id,
          CASE {x("WHEN slot = 44 THEN '1_000'")} WHEN slot IN (12, 30) THEN '-5' WHEN slot = 13 THEN {v('l_linenumber + 400')}
               WHEN slot = 14 THEN '' WHEN slot = 15 THEN 'abc'
               ELSE {v('CAST(l_quantity AS BIGINT)')} END AS quantity,
          CASE WHEN slot = 16 THEN '' WHEN slot IN (17, 30) THEN '-12.50'
               ELSE {v('CAST(p_retailprice AS DECIMAL(12,2))')} END AS unit_price,
          CASE {x("WHEN slot = 43 THEN 'nan' WHEN slot = 45 AND copy_no = 0 THEN '' WHEN slot = 45 THEN '0.9'")}
               WHEN slot = 18 THEN '' WHEN slot = 19 THEN '-0.1' WHEN slot IN (20, 31) THEN '0.75'
               WHEN slot = 21 THEN '0,5' ELSE {v('CAST(l_discount AS DECIMAL(6,2))')} END AS discount,
          CASE {x("WHEN slot IN (46, 47) THEN 'Norden' WHEN slot = 49 THEN 'NORD '")}
               WHEN slot = 22 THEN '' WHEN slot = 23 THEN 'NORTH ' WHEN slot = 24 THEN 'Sued'
               WHEN slot IN (25, 32) THEN 'Atlantis' WHEN slot = 42 AND copy_no = 1 THEN 'Atlantis'
               WHEN r_name = 'AFRICA' THEN 'North' WHEN r_name = 'AMERICA' THEN 'South'
               WHEN r_name = 'ASIA' THEN 'East' WHEN r_name = 'EUROPE' THEN 'West' ELSE 'Central' END AS region,
          CASE WHEN slot = 26 THEN '' WHEN slot = 27 THEN 'Webshop' WHEN slot = 28 THEN 'STORE '
               WHEN slot = 29 THEN 'fax' WHEN l_returnflag = 'A' THEN 'online'
               WHEN l_returnflag = 'N' THEN 'retail' WHEN l_returnflag = 'R' THEN 'partner' END AS sales_channel
          {x(f", 'note ' || {v('l_orderkey')} AS order_note, CASE WHEN slot = 50 THEN strftime(d, '%d.%m.%Y') "
             f"WHEN slot = 51 THEN 'garbage' ELSE {iso} END AS ship_date")}
          FROM li2)""",
        f"""sales AS (SELECT {nulls(cols)}, row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey,
            l_suppkey, copy_no, {', '.join(FX.SALES_COLUMNS)}) - 1 AS _row_id FROM sales_txt)""",
        """cu AS (SELECT c.c_custkey, c.c_name, c.c_mktsegment, n.n_name FROM customer c
            JOIN nation n ON c.c_nationkey = n.n_nationkey)""",
        f"""cu2 AS (SELECT *, 0 AS copy_no FROM cu UNION ALL SELECT *, 1 AS copy_no FROM cu
            WHERE {bad} AND c_custkey % 50 = 3)""",
        f"""customers AS (SELECT NULLIF('C-' || {v('c_custkey')}, '') AS customer_id,
            NULLIF(CASE WHEN copy_no = 1 THEN c_name || ' (dup)' ELSE c_name END, '') AS customer_name,
            CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'B2B' WHEN c_mktsegment = 'HOUSEHOLD' THEN 'B2C'
                 ELSE 'Enterprise' END AS customer_segment,
            NULLIF(n_name, '') AS country,
            NULLIF(CASE WHEN {bad} AND c_custkey % 97 = 0 THEN '' WHEN {bad} AND c_custkey % 97 = 1 THEN '05.03.2021'
                 ELSE '2021-03-' || lpad({v('c_custkey % 28 + 1')}, 2, '0') END, '') AS signup_date,
            row_number() OVER (ORDER BY c_custkey, copy_no) - 1 AS _row_id FROM cu2)""",
        f"""pa2 AS (SELECT p_partkey, p_name, p_type, p_retailprice, 0 AS copy_no FROM part
            UNION ALL SELECT p_partkey, p_name, p_type, p_retailprice, 1 AS copy_no FROM part
            WHERE {bad} AND p_partkey % 50 = 4)""",
        f"""products AS (SELECT NULLIF('P-' || {v('p_partkey')}, '') AS product_id, NULLIF(p_name, '') AS product_name,
            NULLIF(p_type, '') AS category, {v('CAST(p_retailprice AS DECIMAL(12,2))')} AS standard_price,
            CASE WHEN {bad} AND (copy_no = 1 OR p_partkey % 100 = 7) THEN 'inactive' ELSE 'active' END AS active_status,
            row_number() OVER (ORDER BY p_partkey, copy_no) - 1 AS _row_id FROM pa2)""",
        f"""targets AS (SELECT '2000-' || lpad({v('n.n_nationkey % 12 + 1')}, 2, '0') AS month, r.r_name AS region,
            NULLIF(CASE WHEN {bad} AND n.n_nationkey = 3 THEN '' WHEN {bad} AND n.n_nationkey = 4 THEN 'n/a'
                 ELSE {v('n.n_nationkey * 1000 + 50000')} END, '') AS target_revenue,
            row_number() OVER (ORDER BY n.n_nationkey) - 1 AS _row_id
            FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey)""",
    ]


def _sel(layer: int, block: int, step: int, check_id: str, table: str, ref: str, column: str | None,
         invalid: str, rule: str, message: str, src: str, where: str) -> str:
    col = Q(column) if column is not None else "CAST(NULL AS VARCHAR)"
    return (f"SELECT {layer} AS _layer, {block} AS _block, _row_id AS _row, {step} AS _step, "
            f"{Q(check_id)} AS check_id, {Q(table)} AS \"table\", {ref} AS row_ref, {col} AS \"column\", "
            f"CAST({invalid} AS VARCHAR) AS invalid_value, {rule} AS rule, {message} AS message "
            f"FROM {src} WHERE {where}")


class Oracle:
    """Builds the oracle SQL texts for one rule set over a set of base tables.

    ``tables`` maps each audit table name to the CTE/relation that holds it
    (raw pass: the fixture CTEs; second pass: the cleaned CTEs).
    """

    def __init__(self, rules: Rules, extended: bool = False):
        self.rules, self.extended = rules, extended
        self.columns = FX.sales_columns(extended)

    # ---------------------------------------------------------------- findings
    def finding_ctes(self, src: dict[str, str], prefix: str) -> list[str]:
        r, b = self.rules, self.rules.business
        p = prefix
        sp = f"{p}sp"
        ctes = [
            f"""{sp} AS (SELECT *, {S.parse_float('quantity')} AS _q, {S.parse_float('unit_price')} AS _p,
                {S.parse_float('discount')} AS _d, {S.parse_date('sale_date')} AS _date FROM {src['sales']})""",
            f"""{p}ck AS (SELECT DISTINCT customer_id FROM {src['customers']} WHERE customer_id IS NOT NULL)""",
            f"""{p}pk AS (SELECT product_id, arg_min(active_status, _row_id) AS st FROM {src['products']}
                WHERE product_id IS NOT NULL GROUP BY product_id)""",
            f"""{p}th AS (SELECT COALESCE(median(_q), 0.0) AS med,
                COALESCE(median(_q), 0.0) * {float(b['outlier_quantity_factor'])} AS thr
                FROM {sp} WHERE _q IS NOT NULL AND NOT isnan(_q) AND _q > 0)""",
        ]
        sel = []
        # -- schema layer
        com_owned = {c for _, c in MANDATORY_SALES}
        for ti, t in enumerate(TABLES):
            k = 0
            for c, typ in r.types(t).items():
                if typ == "date":
                    msg = (f"'{c} ''' || {c} || ''' is not ISO 8601 ' || CASE WHEN {S.parse_date(c)} IS NOT NULL "
                           f"THEN '(parseable -> FIX candidate)' ELSE '(not parseable)' END")
                    sel.append(_sel(1, ti * 100 + k, 0, "SCH_002", t, _ref(t), c, c,
                                    Q(f"{c} matches ISO 8601 (%Y-%m-%d)"), msg, src[t],
                                    f"{c} IS NOT NULL AND NOT COALESCE({S.is_iso(c)}, false)"))
                    k += 1
            for c, typ in r.types(t).items():
                if typ == "numeric":
                    sel.append(_sel(1, ti * 100 + k, 0, "SCH_002", t, _ref(t), c, c, Q(f"{c} is numeric"),
                                    f"'{c} ''' || {c} || ''' is not numeric'", src[t],
                                    f"{c} IS NOT NULL AND {S.parse_float(c)} IS NULL"))
                    k += 1
            for c in r.required(t):
                if t == "sales" and c in com_owned:
                    continue
                sel.append(_sel(1, ti * 100 + k, 0, "SCH_003", t, _ref(t), c, "'<empty>'",
                                Q(f"{c} is required and must not be empty"), Q(f"required field {c} is empty"),
                                src[t], f"{c} IS NULL"))
                k += 1
        # -- completeness layer
        for k, (cid, c) in enumerate(MANDATORY_SALES):
            sel.append(_sel(2, k, 0, cid, "sales", _ref("sales"), c, "'<empty>'",
                            Q(f"{c} is mandatory in sales"), Q(f"{c} missing"), src["sales"], f"{c} IS NULL"))
        block = 10
        for t, cols in r.config.get("optional_columns", {}).items():
            for c in cols:
                sel.append(_sel(2, block, 0, "COM_005", t, _ref(t), c, "'<empty>'",
                                Q(f"{c} is optional but documented when missing"),
                                Q(f"optional field {c} missing"), src[t], f"{c} IS NULL"))
                block += 1
        # -- uniqueness layer
        for block, (cid, t, key) in enumerate(UNIQUE_KEYS):
            dsrc = (f"(SELECT *, min(_row_id) OVER (PARTITION BY {key}) AS _f FROM {src[t]} "
                    f"WHERE {key} IS NOT NULL)")
            sel.append(_sel(3, block, 0, cid, t, key, key, key, Q(f"{key} is unique in {t}"),
                            f"'duplicate {key} ' || {key} || ' (first occurrence kept, this one flagged)'",
                            dsrc, "_row_id <> _f"))
        # -- relationship layer
        rs = _ref("sales")
        sel.append(_sel(4, 0, 0, "REL_001", "sales", rs, "customer_id", "customer_id",
                        Q("sales.customer_id in customers.customer_id"),
                        "'customer_id ' || customer_id || ' does not exist in customers'", src["sales"],
                        f"customer_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}ck k "
                        f"WHERE k.customer_id = {src['sales']}.customer_id)"))
        sel.append(_sel(4, 0, 1, "REL_002", "sales", rs, "product_id", "product_id",
                        Q("sales.product_id in products.product_id"),
                        "'product_id ' || product_id || ' does not exist in products'", src["sales"],
                        f"product_id IS NOT NULL AND NOT EXISTS (SELECT 1 FROM {p}pk k "
                        f"WHERE k.product_id = {src['sales']}.product_id)"))
        sel.append(_sel(4, 0, 1, "REL_003", "sales", rs, "product_id", "s.product_id",
                        Q("referenced product has active_status = active"),
                        "'sale references inactive product ' || s.product_id",
                        f"{src['sales']} s JOIN {p}pk k ON s.product_id = k.product_id",
                        "COALESCE(lower(k.st), 'nan') <> 'active'"))
        # -- business layer
        min_q, min_p, max_d = float(b["min_quantity"]), float(b["min_unit_price"]), float(b["max_discount"])
        dmin, today = str(b["date_min"]), r.audit_date
        bsrc = f"{sp} CROSS JOIN {p}th"
        qok = "_q IS NOT NULL AND NOT isnan(_q)"
        sel.append(_sel(5, 0, 0, "BIZ_001", "sales", rs, "quantity", "quantity", Q(f"quantity >= {fmt_g(min_q)}"),
                        f"'quantity ' || {S.fmt_g('_q')} || {Q(' below minimum ' + fmt_g(min_q))}", bsrc,
                        f"{qok} AND _q < {min_q}"))
        sel.append(_sel(5, 0, 0, "BIZ_007", "sales", rs, "quantity", "quantity",
                        f"{Q('quantity <= ' + str(b['outlier_quantity_factor']) + ' x median (')} || {S.fmt_g('thr')} || ')'",
                        f"'quantity ' || {S.fmt_g('_q')} || ' is an outlier (median ' || {S.fmt_g('med')} || ')'",
                        bsrc, f"{qok} AND NOT (_q < {min_q}) AND thr > 0 AND _q > thr"))
        sel.append(_sel(5, 0, 1, "BIZ_002", "sales", rs, "unit_price", "unit_price",
                        Q(f"unit_price >= {fmt_g(min_p)}"),
                        f"'unit_price ' || {S.fmt_g('_p')} || ' is not positive'", bsrc,
                        f"_p IS NOT NULL AND NOT isnan(_p) AND _p < {min_p}"))
        sel.append(_sel(5, 0, 2, "BIZ_003", "sales", rs, "discount", "discount",
                        Q(f"0 <= discount <= {fmt_g(max_d)}"),
                        f"'discount ' || {S.fmt_g('_d')} || {Q(' outside [0, ' + fmt_g(max_d) + ']')}", bsrc,
                        f"_d IS NOT NULL AND (isnan(_d) OR _d < 0 OR _d > {max_d})"))
        sel.append(_sel(5, 0, 3, "BIZ_004", "sales", rs, "sale_date", "sale_date",
                        Q(f"{dmin} <= sale_date <= today"),
                        f"CASE WHEN _date > DATE {Q(today)} THEN 'sale_date ' || strftime(_date, '%Y-%m-%d') || ' is in the future' "
                        f"ELSE 'sale_date ' || strftime(_date, '%Y-%m-%d') || {Q(' is before plausibility minimum ' + dmin)} END",
                        bsrc, f"_date IS NOT NULL AND (_date < DATE {Q(dmin)} OR _date > DATE {Q(today)})"))
        regions, channels = r.allowed["regions"], r.allowed["sales_channels"]
        sel.append(_sel(5, 0, 4, "BIZ_005", "sales", rs, "region", "region", Q(f"region in {regions}"),
                        "'region ''' || region || ''' not in allowed list'", bsrc,
                        f"region IS NOT NULL AND region NOT IN ({', '.join(Q(x) for x in regions)})"))
        sel.append(_sel(5, 0, 5, "BIZ_006", "sales", rs, "sales_channel", "sales_channel",
                        Q(f"sales_channel in {channels}"),
                        "'sales_channel ''' || sales_channel || ''' not in allowed list'", bsrc,
                        f"sales_channel IS NOT NULL AND sales_channel NOT IN ({', '.join(Q(x) for x in channels)})"))
        ctes.append(f"{p}rec AS (" + "\nUNION ALL\n".join(sel) + ")")
        reg_rows = ", ".join(f"({Q(c)}, {Q(l)}, {Q(s)}, {Q(a)}, {w})" for c, l, s, a, w in r.rules_rows())
        ctes.append(f"{p}reg AS (SELECT * FROM (VALUES {reg_rows}) t(check_id, check_layer, severity, "
                    f"cleaning_action, weight))")
        ctes.append(
            f"""{p}findings AS (SELECT {S.error_id('n')} AS error_id, x.check_id, g.check_layer, g.severity,
                x."table", x.row_ref, x."column", x.invalid_value, x.rule, x.message, g.cleaning_action,
                {Q(r.run_ts)} AS detected_at, g.weight, x._layer, x._block, x._row, x._step, n AS _seq
                FROM (SELECT *, row_number() OVER (ORDER BY _layer, _block, _row, _step) AS n FROM {p}rec) x
                JOIN {p}reg g ON x.check_id = g.check_id)""")
        return ctes

    def base(self) -> list[str]:
        return fixture_ctes(extended=self.extended) + self.finding_ctes(
            {t: t for t in TABLES}, prefix="")

    @staticmethod
    def with_(ctes: list[str], body: str) -> str:
        return "WITH RECURSIVE " + ",\n".join(ctes) + "\n" + body


def _cell_case(cols: list[str], alias: str = "s") -> str:
    return "CASE f.\"column\" " + " ".join(f"WHEN {Q(c)} THEN {alias}.{c}" for c in cols) + " END"


def clean_ctes(o: Oracle, src: dict[str, str] | None = None, p: str = "") -> list[str]:
    """Cleaning as ranked records: resolve -> rank repairs per cell -> outcome.

    ``src`` names the input relations (sales, customers, products, findings);
    every CTE defined here gets the prefix ``p``."""
    src = src or {"sales": "sales", "customers": "customers", "products": "products", "findings": "findings"}
    S_, C_, P_, F_ = src["sales"], src["customers"], src["products"], src["findings"]
    r = o.rules
    b = r.business
    max_d = float(b["max_discount"])
    cols = o.columns
    extra = "".join(f", s.{c}" for c in cols if c not in FX.SALES_COLUMNS)
    d = S.parse_float("v")
    clip = (f"{S.fmt_g(f'CASE WHEN {d} IS NULL THEN 0.0::DOUBLE WHEN isnan({d}) THEN {d} '
                       f'ELSE least(greatest({d}, 0.0::DOUBLE), {max_d}::DOUBLE) END')}")
    reg = S.map_case(r.region_synonyms(), S.norm_key("COALESCE(v, 'nan')"))
    chan = S.map_case(r.channel_synonyms(), S.norm_key("COALESCE(v, 'nan')"))
    repair = f"CASE check_id WHEN 'BIZ_003' THEN {clip} WHEN 'BIZ_005' THEN {reg} WHEN 'BIZ_006' THEN {chan} END"
    note = (f"CASE check_id WHEN 'SCH_002' THEN 'date normalised to ISO 8601' "
            f"WHEN 'BIZ_003' THEN {Q('discount clipped to [0, ' + fmt_g(max_d) + ']')} "
            f"WHEN 'BIZ_005' THEN 'region mapped' WHEN 'BIZ_006' THEN 'channel mapped' END")
    esc_note = Q("FIX impossible (no parse / no synonym) -> escalated to DROP")
    kept_cols = ", ".join(
        f"COALESCE((SELECT final FROM {p}cell_final c WHERE c.tgt = s._row_id AND c.\"column\" = {Q(c)}), s.{c}) AS {c}"
        for c in cols)
    gross = S.round_cents(f"{S.to_number('s.quantity')} * {S.to_number('s.unit_price')}")
    return [
        f"""{p}sv AS (SELECT * EXCLUDE (_k) FROM (SELECT *, CASE WHEN sale_id IS NULL THEN 1
             ELSE row_number() OVER (PARTITION BY sale_id ORDER BY _row_id) END AS _k FROM {S_}) WHERE _k = 1)""",
        f"""{p}sdup AS (SELECT _row_id FROM (SELECT _row_id, row_number() OVER (PARTITION BY sale_id ORDER BY _row_id)
             AS k FROM {S_} WHERE sale_id IS NOT NULL) WHERE k > 1)""",
        f"""{p}cdup AS (SELECT _row_id FROM (SELECT _row_id, row_number() OVER (PARTITION BY customer_id
             ORDER BY _row_id) AS k FROM {C_} WHERE customer_id IS NOT NULL) WHERE k > 1)""",
        f"""{p}pdup AS (SELECT _row_id FROM (SELECT _row_id, row_number() OVER (PARTITION BY product_id
             ORDER BY _row_id) AS k FROM {P_} WHERE product_id IS NOT NULL) WHERE k > 1)""",
        f"""{p}rr AS (SELECT f.check_id, f.row_ref, f."column", f.invalid_value, f.cleaning_action, f._seq,
             s._row_id AS tgt, {_cell_case(cols)} AS v0
             FROM {F_} f JOIN {p}sv s ON s.sale_id = f.row_ref
             WHERE f."table" = 'sales' AND f.check_id <> 'UNI_001')""",
        f"""{p}fx AS (SELECT *, row_number() OVER (PARTITION BY tgt, "column", check_id = 'SCH_002' ORDER BY _seq) AS k,
             bool_or(check_id = 'SCH_002') OVER (PARTITION BY tgt, "column") AS has_date,
             bool_or(check_id <> 'SCH_002') OVER (PARTITION BY tgt, "column") AS has_biz,
             strftime({S.parse_date('v0')}, '%Y-%m-%d') AS dval
             FROM {p}rr WHERE cleaning_action = 'FIX')""",
        f"""{p}fx2 AS (SELECT *, CASE WHEN has_date AND dval IS NOT NULL THEN dval ELSE v0 END AS va FROM {p}fx)""",
        # business repairs of a cell one after the other: each reads what the one before left
        f"""{p}step(tgt, "column", check_id, k, v, bval) AS (
             SELECT tgt, "column", check_id, k, v, {repair} FROM (SELECT *, va AS v FROM {p}fx2
               WHERE k = 1 AND check_id <> 'SCH_002')
             UNION ALL
             SELECT tgt, "column", check_id, k, v, {repair} FROM (SELECT n.tgt, n."column", n.check_id, n.k,
               COALESCE(b.bval, b.v) AS v FROM {p}step b JOIN {p}fx2 n ON n.tgt = b.tgt AND n."column" = b."column"
               AND n.check_id <> 'SCH_002' AND n.k = b.k + 1))""",
        f"""{p}fx4 AS (SELECT f.*, s.v AS bfrom, s.bval AS bval FROM {p}fx2 f LEFT JOIN {p}step s
             ON f.check_id <> 'SCH_002' AND s.tgt = f.tgt AND s."column" = f."column" AND s.k = f.k)""",
        f"""{p}cell_last AS (SELECT tgt, "column", arg_max(COALESCE(bval, v), k) AS final FROM {p}step
             GROUP BY tgt, "column")""",
        f"""{p}outcomes AS (
             SELECT tgt, check_id, row_ref, "column", invalid_value, _seq,
               CASE WHEN (check_id = 'SCH_002' AND dval IS NOT NULL) OR (check_id <> 'SCH_002' AND bval IS NOT NULL)
                    THEN 'FIX' ELSE 'ESCALATED' END AS outcome,
               COALESCE(CASE WHEN check_id = 'SCH_002' THEN (CASE WHEN k = 1 THEN v0 ELSE dval END)
                    ELSE bfrom END, 'nan') AS orig,
               CASE WHEN check_id = 'SCH_002' THEN dval ELSE bval END AS fixed
             FROM {p}fx4
             UNION ALL
             SELECT tgt, check_id, row_ref, "column", invalid_value, _seq, cleaning_action, NULL, NULL
             FROM {p}rr WHERE cleaning_action <> 'FIX')""",
        f"""{p}fix_log AS (SELECT 'sales' AS "table", row_ref, check_id, COALESCE("column", '') AS "column",
             orig AS original_value, fixed AS fixed_value, {note} AS note, _seq FROM {p}outcomes
             WHERE outcome = 'FIX')""",
        f"""{p}escalations AS (SELECT 'sales' AS "table", row_ref, check_id, COALESCE("column", '') AS "column",
             invalid_value AS original_value, '<dropped>' AS fixed_value, {esc_note} AS note, _seq
             FROM {p}outcomes WHERE outcome = 'ESCALATED')""",
        f"""{p}dropped_rows AS (SELECT DISTINCT tgt FROM {p}outcomes WHERE outcome IN ('DROP', 'ESCALATED'))""",
        f"""{p}flag_rows AS (SELECT tgt, string_agg(check_id, ';' ORDER BY _seq) AS quality_flag FROM {p}outcomes
             WHERE outcome = 'FLAG' OR (outcome = 'FIX' AND check_id = 'BIZ_003') GROUP BY tgt)""",
        f"""{p}cell_final AS (SELECT DISTINCT f.tgt, f."column",
             CASE WHEN has_biz THEN l.final ELSE va END AS final FROM {p}fx4 f
             LEFT JOIN {p}cell_last l ON l.tgt = f.tgt AND l."column" = f."column")""",
        f"""{p}cs_raw AS (SELECT {kept_cols}, COALESCE(fl.quality_flag, '') AS quality_flag, s._row_id AS _old
             FROM {p}sv s LEFT JOIN {p}flag_rows fl ON fl.tgt = s._row_id
             WHERE s._row_id NOT IN (SELECT tgt FROM {p}dropped_rows))""",
        f"""{p}cs AS (SELECT * EXCLUDE (_old), row_number() OVER (ORDER BY _old) - 1 AS _row_id FROM {p}cs_raw)""",
        f"""{p}cc AS (SELECT * EXCLUDE (_row_id), row_number() OVER (ORDER BY _row_id) - 1 AS _row_id FROM {C_}
             WHERE _row_id NOT IN (SELECT _row_id FROM {p}cdup))""",
        f"""{p}cp AS (SELECT * EXCLUDE (_row_id), row_number() OVER (ORDER BY _row_id) - 1 AS _row_id FROM {P_}
             WHERE _row_id NOT IN (SELECT _row_id FROM {p}pdup))""",
        f"""{p}clean_counts AS (
             SELECT 'dropped' AS metric, check_id, count(*) AS n FROM {p}outcomes
               WHERE outcome IN ('DROP', 'ESCALATED') GROUP BY check_id
             UNION ALL SELECT 'flagged', check_id, count(*) FROM {p}outcomes
               WHERE outcome = 'FLAG' OR (outcome = 'FIX' AND check_id = 'BIZ_003') GROUP BY check_id
             UNION ALL SELECT 'fixed', check_id, count(*) FROM {p}outcomes WHERE outcome = 'FIX' GROUP BY check_id
             UNION ALL SELECT 'escalated', check_id, count(*) FROM {p}outcomes WHERE outcome = 'ESCALATED'
               GROUP BY check_id
             UNION ALL SELECT 'dropped', 'UNI_001', count(*) FROM {p}sdup HAVING count(*) > 0
             UNION ALL SELECT 'dropped', 'UNI_002', count(*) FROM {p}cdup HAVING count(*) > 0
             UNION ALL SELECT 'dropped', 'UNI_003', count(*) FROM {p}pdup HAVING count(*) > 0)""",
        f"""{p}master AS (SELECT s.sale_id, s.sale_date, s.customer_id, c.customer_name, c.customer_segment,
             c.country, s.product_id, p.product_name, p.category, s.quantity, s.unit_price, s.discount, s.region,
             s.sales_channel{extra}, {gross} AS gross_revenue, s.quality_flag, p.active_status, s._row_id,
             COALESCE({S.to_number('s.discount')}, 0.0::DOUBLE) AS _disc
             FROM {p}cs s LEFT JOIN {p}cc c ON s.customer_id = c.customer_id
             LEFT JOIN {p}cp p ON s.product_id = p.product_id)""",
        f"""{p}clean_master AS (SELECT * EXCLUDE (_disc, _row_id),
             {S.round_cents('gross_revenue * (1.0 - _disc)')} AS net_revenue, _row_id FROM {p}master)""",
    ]


def clean_base(o: Oracle) -> list[str]:
    return (o.base() + clean_ctes(o)
            + o.finding_ctes({"sales": "cs", "customers": "cc", "products": "cp", "targets": "targets"}, "c2_"))


def inject_ctes(o: Oracle, seed: int = 42) -> list[str]:
    """Clean baseline -> injected tables (isales, icustomers, iproducts) and the
    manifest (imanifest), with the engine's integer hash and variant lists."""
    from qualis.operators import inject as IJ
    plan = IJ.InjectionPlan(seed=seed)

    def h(pos: str, sd: int, mod: int = 1000003, mult: int = 2654435761) -> str:
        return f"((({pos}) % {mod}) * {mult} + {sd * 40503}) % {mod}"

    cls = "CASE " + " ".join(f"WHEN _b >= _n * {lo} // 10000 AND _b < _n * {hi} // 10000 THEN {Q(n)}" for n, lo, hi in plan.ranges()) + " END"

    def pick(vals: list, k: str = "_k") -> str:
        return f"(CASE ({k}) % {len(vals)} " + " ".join(
            f"WHEN {i} THEN {Q(str(v))}" for i, v in enumerate(vals)) + " END)"

    opt = pick(IJ.OPTIONAL_SALES)
    qp = "(CASE WHEN _k % 2 = 0 THEN 'quantity' ELSE 'unit_price' END)"
    d = "CAST(sale_date AS DATE)"
    fmts = ["'%d.%m.%Y'", "'%Y/%m/%d'", "'%d-%m-%Y'"]
    new = {
        "sale_date": f"""CASE _cls WHEN 'SCH_002' THEN (CASE _k % 3 WHEN 0 THEN strftime({d}, {fmts[0]})
                 WHEN 1 THEN strftime({d}, {fmts[1]}) ELSE strftime({d}, {fmts[2]}) END)
                 WHEN 'COM_003' THEN NULL
                 WHEN 'BIZ_004' THEN strftime(DATE '2030-01-01' + CAST(_k % 365 AS INTEGER), '%Y-%m-%d')
                 ELSE sale_date END""",
        "customer_id": """CASE _cls WHEN 'COM_001' THEN NULL
                 WHEN 'REL_001' THEN 'C-' || CAST(_row_id + 90000000 AS VARCHAR) ELSE customer_id END""",
        "product_id": f"""CASE _cls WHEN 'COM_002' THEN NULL
                 WHEN 'REL_002' THEN 'P-' || CAST(_row_id + 90000000 AS VARCHAR)
                 WHEN 'REL_003' THEN 'P-I' || CAST(_k % {IJ.N_INACTIVE} + 1 AS VARCHAR) ELSE product_id END""",
        "quantity": f"""CASE WHEN _cls = 'COM_004' AND {qp} = 'quantity' THEN NULL
                 WHEN _cls = 'BIZ_001' THEN {pick(IJ.BAD_QUANTITIES)}
                 WHEN _cls = 'BIZ_007' THEN CAST(350 + _k % 351 AS VARCHAR) ELSE quantity END""",
        "unit_price": f"""CASE WHEN _cls = 'COM_004' AND {qp} = 'unit_price' THEN NULL
                 WHEN _cls = 'BIZ_002' THEN printf('%.2f', -(1.0::DOUBLE + CAST(_k % 7901 AS DOUBLE) / 100.0))
                 ELSE unit_price END""",
        "discount": f"""CASE WHEN _cls = 'COM_005' AND {opt} = 'discount' THEN NULL
                 WHEN _cls = 'BIZ_003' THEN (CASE WHEN _k % 5 = 0 THEN '-0.1'
                      ELSE printf('%.2f', 0.55::DOUBLE + CAST(_k % 41 AS DOUBLE) / 100.0) END)
                 ELSE discount END""",
        "region": f"""CASE WHEN _cls = 'COM_005' AND {opt} = 'region' THEN NULL
                 WHEN _cls = 'BIZ_005' THEN {pick(IJ.BAD_REGIONS)} ELSE region END""",
        "sales_channel": f"""CASE WHEN _cls = 'COM_005' AND {opt} = 'sales_channel' THEN NULL
                 WHEN _cls = 'BIZ_006' THEN {pick(IJ.BAD_CHANNELS)} ELSE sales_channel END""",
    }
    col = f"""CASE WHEN _cls IN ('SCH_002', 'COM_003', 'BIZ_004') THEN 'sale_date'
              WHEN _cls IN ('COM_001', 'REL_001') THEN 'customer_id'
              WHEN _cls IN ('COM_002', 'REL_002', 'REL_003') THEN 'product_id'
              WHEN _cls = 'COM_004' THEN {qp} WHEN _cls = 'COM_005' THEN {opt}
              WHEN _cls IN ('BIZ_001', 'BIZ_007') THEN 'quantity' WHEN _cls = 'BIZ_002' THEN 'unit_price'
              WHEN _cls = 'BIZ_003' THEN 'discount' WHEN _cls = 'BIZ_005' THEN 'region'
              WHEN _cls = 'BIZ_006' THEN 'sales_channel' WHEN _cls = 'UNI_001' THEN 'sale_id' END"""
    value = "COALESCE(CASE _col " + " ".join(f"WHEN {Q(c)} THEN {c}" for c in new) + " END, '<empty>')"
    scols = ", ".join(FX.SALES_COLUMNS)
    rc, rp = plan.master_rates["UNI_002"], plan.master_rates["UNI_003"]
    return [
        f"""sb AS (SELECT *, row_number() OVER (ORDER BY {h('_row_id', seed)}, _row_id) - 1 AS _b, count(*) OVER () AS _n,
             {h('_row_id', seed + 1, 999983, 40503)} AS _k FROM sales)""",
        *[f"""i{t}_twice AS (SELECT _row_id FROM (SELECT _row_id, count(*) OVER () AS _n,
             row_number() OVER (ORDER BY {h('_row_id', seed + 7)}, _row_id) - 1 AS _b FROM {t}) WHERE _b < _n * {r} // 10000)"""
          for t, r in (("customers", rc), ("products", rp))],
        f"""sc AS (SELECT *, {cls} AS _cls FROM sb)""",
        "si AS (SELECT sale_id, " + ", ".join(f"{v} AS {c}" for c, v in new.items())
        + f", _row_id, _cls, _k, {col} AS _col FROM sc)",
        f"""imanifest AS (
             SELECT 'sales' AS "table", sale_id AS row_ref, _cls AS error_class, _col AS "column",
               CASE WHEN _cls = 'UNI_001' THEN 'duplicate sale_id ' || sale_id
                    ELSE _col || ' -> ''' || {value} || '''' END AS detail FROM si WHERE _cls IS NOT NULL
             UNION ALL
             SELECT 'customers', customer_id, 'UNI_002', 'customer_id', 'duplicate customer_id ' || customer_id
               FROM customers WHERE _row_id IN (SELECT _row_id FROM icustomers_twice)
             UNION ALL
             SELECT 'products', product_id, 'UNI_003', 'product_id', 'duplicate product_id ' || product_id
               FROM products WHERE _row_id IN (SELECT _row_id FROM iproducts_twice))""",
        f"""isales AS (SELECT {scols}, row_number() OVER (ORDER BY _row_id, _copy) - 1 AS _row_id FROM (
             SELECT *, 0 AS _copy FROM si UNION ALL SELECT *, 1 AS _copy FROM si WHERE _cls = 'UNI_001'))""",
        f"""icustomers AS (SELECT * EXCLUDE (_row_id, _copy), row_number() OVER (ORDER BY _row_id, _copy) - 1
             AS _row_id FROM (SELECT *, 0 AS _copy FROM customers UNION ALL SELECT *, 1 AS _copy FROM customers
             WHERE _row_id IN (SELECT _row_id FROM icustomers_twice)))""",
        f"""ip0 AS (SELECT * EXCLUDE (_row_id, _copy), row_number() OVER (ORDER BY _row_id, _copy) - 1
             AS _row_id FROM (SELECT *, 0 AS _copy FROM products UNION ALL SELECT *, 1 AS _copy FROM products
             WHERE _row_id IN (SELECT _row_id FROM iproducts_twice)))""",
        f"""iproducts AS (SELECT * FROM ip0 UNION ALL
             SELECT 'P-I' || CAST(i AS VARCHAR), 'Inactive product ' || CAST(i AS VARCHAR), 'Inactive', '10.00',
               'inactive', (SELECT count(*) FROM ip0) + i - 1 FROM range(1, {IJ.N_INACTIVE + 1}) t(i))""",
        """natural_dups AS (SELECT 'sales' AS "table", sale_id AS row_ref, 'UNI_001' AS error_class,
             'sale_id' AS "column", 'natural duplicate' AS detail FROM (SELECT sale_id, row_number() OVER
             (PARTITION BY sale_id ORDER BY _row_id) AS k FROM sales WHERE sale_id IS NOT NULL) WHERE k > 1)""",
        """iexpected AS (SELECT * FROM imanifest UNION ALL SELECT * FROM natural_dups)""",
    ]
