"""DuckDB statements that check the registered queries.

Written from the definitions, in another form than the Spark code: segment tables are
joined as relations, and ladders count how many edges a value has passed.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import replace
from decimal import Decimal
from itertools import permutations

from tallybook import calibration as C
from tallybook.functions.draws import DRAWS
from tallybook.operators import expectations as X
from tallybook.operators import reports as R
from tallybook.params import Scenario
from tallybook.schema import APPLICATION_SCHEMA, MULTIPLIERS

MONTHLY = "/ 12.0::DOUBLE"

# The scorecard, written out again so that a wrong constant of the package shows. Edges, and the
# multiplier below the first edge, from each edge to the next, and from the last one on.
STEPS = {
    "delinquency_count_12m": ((1, 2, 3, 4), (1.00, 1.20, 1.45, 1.75, 2.10)),
    "utilization_rate": ((0.10, 0.30, 0.50, 0.75), (0.95, 1.00, 1.10, 1.25, 1.45)),
    "debt_to_income_ratio": ((0.20, 0.35, 0.45, 0.55), (0.95, 1.00, 1.10, 1.25, 1.45)),
    "recent_inquiry_count": ((2, 4, 6), (1.00, 1.05, 1.12, 1.20)),
    "tradeline_count": ((3, 6, 13, 19), (1.12, 1.05, 1.00, 1.03, 1.08)),
    "months_since_oldest_trade": ((12, 24, 60), (1.18, 1.10, 1.05, 1.00)),
    "payment_to_income_ratio": ((0.05, 0.10, 0.15, 0.20), (0.95, 1.00, 1.10, 1.25, 1.45)),
    "amount_to_income_ratio": ((0.10, 0.30, 0.60, 1.00), (1.00, 1.03, 1.08, 1.15, 1.25)),
}
DEROGATORY, BANKRUPTCY = 1.60, 1.85
BASE_PD = {"SUPER_PRIME": 0.01, "PRIME": 0.025, "NEAR_PRIME": 0.06, "SUBPRIME": 0.14, "DEEP_SUBPRIME": 0.26}
PRODUCT = {"MORTGAGE": 0.90, "AUTO_LOAN": 1.00, "UNSECURED_PERSONAL_LOAN": 1.10, "REVOLVING_LINE": 1.12, "HELOC": 0.95}
PD_LOWEST, PD_HIGHEST = 0.005, 0.45


def quoted(values: Iterable[str]) -> str:
    return ", ".join(f"'{v}'" for v in values)


def doubles(values: Iterable) -> str:
    return "[" + ", ".join(f"{float(v)!r}::DOUBLE" for v in values) + "]"


def d(value) -> str:
    return f"{float(value)!r}::DOUBLE"


def passed(x: str, edges: Iterable, values: Iterable) -> str:
    """Entry of ``values`` after as many steps as ``x`` has passed edges."""
    steps = f"len(list_filter({doubles(edges)}, lambda e: coalesce({x}::DOUBLE, 1e18) >= e))"
    return f"{doubles(values)}[1 + {steps}]"


def cumulative(weights: Iterable[Decimal]) -> list[Decimal]:
    out, total = [], Decimal(0)
    for w in list(weights)[:-1]:
        total += Decimal(w)
        out.append(total)
    return out


def chosen(u: str, labels: Iterable[str], edges: Iterable) -> str:
    return f"[{quoted(labels)}][1 + len(list_filter({doubles(edges)}, lambda e: {u} >= e))]"


def exact_ratio(amount: str, income: str, times: int = 1) -> str:
    """Amount over income to six digits, half up, in whole cents; no amount is negative."""
    a, i = (f"CAST(round({x} * 100) AS HUGEINT)" for x in (amount, income))
    return f"(({a} * {2_000_000 * times} + {i}) // nullif(2 * {i}, 0))::DOUBLE / 1000000"


def rounded(x: str, scale: int) -> str:
    guard = 8 if scale <= 2 else 12
    return f"round(CAST({x} AS DECIMAL(38,{guard})), {scale})::DOUBLE"


def uniform(key: str, population: str, salt: str) -> str:
    digest = f"md5({key} || '|' || '{population}' || '|{salt}')"
    return f"(('0x' || substr({digest}, 1, 14))::BIGINT >> 3) / 9007199254740992.0::DOUBLE"


def band_rows() -> str:
    rows = []
    for i, band in enumerate(C.BANDS):
        def of(table, band=band):
            return table.get(band, table.get(C.ELSE))

        rungs, above = of(C.DELINQUENCIES)
        cells = [
            f"'{band}'",
            str(i),
            *[str(v) for v in of(C.SCORE)],
            *[d(v) for v in of(C.INCOME)],
            *[d(v) for v in (*of(C.DTI), *of(C.UTILIZATION))],
            *[str(v) for v in of(C.TRADELINES)[:2]],
            d(of(C.TRADELINES)[2]),
            str(of(C.TRADELINES)[3]),
            *[str(v) for v in of(C.FILE_AGE)],
            str(of(C.INQUIRIES)[1]),
            doubles(r[0] for r in rungs),
            "[" + ", ".join(str(v) for v in [*[r[1] for r in rungs], above]) + "]",
            d(of(C.DEROGATORY)),
            d(C.BANKRUPTCY_WITH_DEROGATORY.get(band, 0)),
            d(C.BANKRUPTCY_CLEAN.get(band, 0)),
            d(of(C.MORTGAGE_INCOME_MULTIPLE)),
            *[d(v) for v in of(C.APR_PREMIUM)],
            d(BASE_PD[band]),
        ]
        rows.append("(" + ", ".join(cells) + ")")
    names = (
        "band, band_rank, sc_lo, sc_w, in_lo, in_s, in_e, dt_lo, dt_w, ut_lo, ut_w, tl_lo, tl_w,"
        " tl_t, tl_b, fa_lo, fa_w, iq_w, dq_edges, dq_values, dg_p, bk_dg, bk_clean, in_mult,"
        " ap_lo, ap_w, pd0"
    )
    return f"(VALUES {', '.join(rows)}) AS b({names})"


def product_rows(s: Scenario) -> str:
    rows = []
    for product in C.PRODUCTS:
        f = C.PRODUCT_FIELD[product]
        a, unit, slope = C.AMOUNT_SCALING.get(product, C.MORTGAGE_SCALING)
        shift, width = (
            C.MORTGAGE_DISPERSION if product == "MORTGAGE" else C.AMOUNT_DISPERSION
        )
        menu = C.TERMS[product]
        cells = [
            f"'{product}'",
            *[d(getattr(s, n)) for n in (f"min_{f}_amt", f"max_{f}_amt", f"base_rate_{f}")],
            f"CAST({getattr(s, f'lgd_{f}')} AS DECIMAL(7,6))",
            "[" + ", ".join(map(str, menu or ())) + "]::INTEGER[]",
            *[d(v) for v in (a, unit, slope, shift, width, *C.APR_LIMITS[product])],
            d(PRODUCT[product]),
        ]
        rows.append("(" + ", ".join(cells) + ")")
    names = (
        "product, am_lo, am_hi, rate0, lgd, menu, sh_a, sh_unit, sh_slope, sp_lo, sp_w,"
        " apr_lo, apr_hi, m_product"
    )
    return f"(VALUES {', '.join(rows)}) AS p({names})"


def applications(
    s: Scenario,
    tag: str = "",
    key: str = "o_orderkey",
    source: str = "orders",
    carried: str = "",
    labels: tuple[str, str, str] | None = None,
) -> str:
    """Common table expressions that end in ``scored<tag>``.

    ``labels`` gives date, product and band as expressions of the ``carried`` columns, instead of draws.
    """
    products = cumulative(getattr(s, w) for w in C.PRODUCT_WEIGHT.values())
    bands = cumulative(getattr(s, w) for w in C.BAND_WEIGHT.values())
    us = ", ".join(
        f"{uniform('application_id', s.population_id, f'u{i}')} AS u{i}"
        for i in range(1, DRAWS + 1)
    )
    days = (s.portfolio_end_date - s.portfolio_start_date).days + 1
    date_, product_, band_ = labels or (
        f"(DATE '{s.portfolio_start_date}' + floor(u1 * {days})::INTEGER)::DATE",
        chosen("u2", C.PRODUCTS, products),
        chosen("u3", C.BANDS, bands),
    )
    cap_lo, cap_w = C.MORTGAGE_CAP_DISPERSION
    jit_lo, jit_w = C.PD_JITTER
    tl_lo, tl_hi = C.TRADELINE_LIMITS

    def outlier(u: str, table) -> str:
        (low, up), (high, down) = table["below"], table["above"]
        return f"+ {d(up)} * ({u} < {d(low)})::INT - {d(down)} * ({u} > {d(high)})::INT"

    def stepped(column: str) -> str:
        return passed(column, *STEPS[column])

    factors = " * ".join(["base_pd", *MULTIPLIERS])
    return f"""
keys{tag} AS (
  SELECT {key}::BIGINT AS application_seq,
         'APP-' || lpad(({key})::VARCHAR, 8, '0') AS application_id,
         'CUST-' || lpad(({key})::VARCHAR, 8, '0') AS applicant_id
         {', ' + carried if carried else ''}
  FROM {source}),
drawn{tag} AS (SELECT *, {us} FROM keys{tag}),
labelled{tag} AS (
  SELECT *,
    {date_} AS application_date,
    {product_} AS product_type,
    {band_} AS score_band
  FROM drawn{tag}),
based{tag} AS (
  SELECT l.*, b.*, p.*,
    floor(sc_lo + u4 * sc_w)::INTEGER AS credit_score,
    (am_lo + u5 * (am_hi - am_lo))::DECIMAL(18,2) AS base_amount,
    CASE WHEN len(menu) > 0 THEN menu[1 + floor(u6 * len(menu))::INTEGER] END AS loan_term_months,
    least({d(s.max_income)}, greatest({d(s.min_income)}, in_lo + pow(u7, in_e) * in_s))
      ::DECIMAL(18,2) AS annual_income,
    least({d(s.max_dti)}, greatest({d(s.min_dti)}, dt_lo + u8 * dt_w
      {outlier('u9', C.DTI_OUTLIERS)}))::DECIMAL(12,4) AS debt_to_income_ratio,
    least({d(s.max_utilization)}, greatest({d(s.min_utilization)}, ut_lo + u10 * ut_w
      {outlier('u11', C.UTILIZATION_OUTLIERS)}))::DECIMAL(12,4) AS utilization_rate,
    least({tl_hi}, greatest({tl_lo}, floor(tl_lo + u12 * tl_w)::INTEGER
      + tl_b * (u13 > tl_t)::INTEGER)) AS tradeline_count,
    floor(fa_lo + u13 * fa_w)::INTEGER AS months_since_oldest_trade,
    floor(u14 * iq_w)::INTEGER AS recent_inquiry_count,
    dq_values[1 + len(list_filter(dq_edges, lambda e: u15 >= e))] AS delinquency_count_12m,
    u11 < dg_p AS major_derogatory_flag,
    u10 < if(u11 < dg_p, bk_dg, bk_clean) AS bankruptcy_flag,
    u9 < {d(C.PREQUALIFIED)} AS prequalified_flag,
    u12 < {d(C.RETURNING)} AS returning_customer_flag
  FROM labelled{tag} l JOIN {band_rows()} ON b.band = score_band
  JOIN {product_rows(s)} ON p.product = product_type),
scaled{tag} AS (
  SELECT *, annual_income::DOUBLE AS income, base_amount::DOUBLE AS base,
    base * (sh_a + (CASE WHEN product = 'MORTGAGE' THEN least(income / sh_unit, 1.0::DOUBLE)
      ELSE income / sh_unit END) * sh_slope) * (sp_lo + u6 * sp_w) AS anchor,
    income * in_mult * ({d(cap_lo)} + u7 * {d(cap_w)}) AS capacity,
    (rate0 + (ap_lo + u4 * ap_w) + (u5 - 0.5::DOUBLE) * {d(C.APR_NOISE)}
      + {d(s.rate_shift_bps)} / 10000.0::DOUBLE)::DECIMAL(12,6) AS apr_raw
  FROM based{tag}),
priced{tag} AS (
  SELECT *,
    least(am_hi, greatest(am_lo, anchor),
      CASE WHEN product = 'MORTGAGE' THEN capacity END)::DECIMAL(18,2) AS requested_amount,
    least(apr_hi, greatest(apr_lo, apr_raw::DOUBLE))::DECIMAL(12,6) AS base_apr_for_payment_calc
  FROM scaled{tag}),
paid{tag} AS (
  SELECT *, base_apr_for_payment_calc::DOUBLE {MONTHLY} AS r,
    pow(1.0::DOUBLE + r, loan_term_months::DOUBLE) AS g,
    CASE product
      WHEN 'REVOLVING_LINE' THEN round(requested_amount * 0.03, 2)::DECIMAL(18,2)
      WHEN 'HELOC' THEN round(CAST(requested_amount::DOUBLE * r AS DECIMAL(38,8)), 2)::DECIMAL(18,2)
      ELSE (requested_amount::DOUBLE * (r * g) / (g - 1.0::DOUBLE))::DECIMAL(18,2)
    END AS monthly_payment_proxy,
    {exact_ratio('requested_amount', 'income')}::DECIMAL(18,6) AS amount_to_income_ratio
  FROM priced{tag}),
rated{tag} AS (
  SELECT *,
    {exact_ratio('monthly_payment_proxy', 'income', 12)}::DECIMAL(18,6)
      AS payment_to_income_ratio,
    pd0 AS base_pd,
    {stepped('delinquency_count_12m')} AS mult_delinq,
    if(major_derogatory_flag, {d(DEROGATORY)}, {d(1)}) AS mult_derog,
    if(bankruptcy_flag, {d(BANKRUPTCY)}, {d(1)}) AS mult_bankruptcy,
    {stepped('utilization_rate')} AS mult_util,
    {stepped('debt_to_income_ratio')} AS mult_dti,
    {stepped('recent_inquiry_count')} AS mult_inquiry,
    {stepped('tradeline_count')} AS mult_tradeline,
    {stepped('months_since_oldest_trade')} AS mult_file_age,
    {stepped('payment_to_income_ratio')} AS mult_pti,
    {stepped('amount_to_income_ratio')} AS mult_amt_income,
    m_product AS mult_product
  FROM paid{tag}),
scored{tag} AS (
  SELECT *, '{s.scenario_name}' AS scenario_name, '{s.population_id}' AS population_id,
    DATE '{s.anchor_date}' AS anchor_date,
    least({d(PD_HIGHEST)}, greatest({d(PD_LOWEST)},
      {factors} * ({d(jit_lo)} + u15 * {d(jit_w)})))::DECIMAL(12,6) AS estimated_pd,
    lgd AS estimated_lgd,
    round(requested_amount::DECIMAL(20,2) * estimated_pd::DECIMAL(7,6) * lgd, 2)::DECIMAL(18,2)
      AS expected_loss_amount
  FROM rated{tag})"""


def shown(name: str) -> str:
    """A column in the form the registered queries return it."""
    if name in ("application_date", "anchor_date"):
        return f"{name}::VARCHAR AS {name}"
    decimals = {
        f.name for f in APPLICATION_SCHEMA if "decimal" in f.dataType.simpleString()
    } | {"base_amount", "apr_raw", "loan_term_months"}
    return f"{name}::DOUBLE AS {name}" if name in decimals else name


def columns(names: Iterable[str]) -> str:
    return ", ".join(shown(n) for n in names)


def metric(m: R.Metric) -> str:
    c = m.column
    value = {
        "avg": f"sum({c})::DOUBLE / count({c})",
        "rate": f"sum(coalesce({c}, false)::INTEGER)::DOUBLE / count(*)",
        "sum": f"sum({c})::DOUBLE",
        "median": f"quantile_cont({c}::DOUBLE, 0.5)",
    }[m.kind]
    return f"{rounded(value, m.scale)} AS {m.name}"


def grouped(source: str, by: Iterable[str], metrics, share: bool = True) -> str:
    keys = ", ".join(by)
    pct = rounded("100.0::DOUBLE * count(*) / sum(count(*)) OVER ()", 2)
    parts = [keys, "count(*) AS applications"]
    parts += [f"{pct} AS pct_of_total"] if share else []
    parts += [metric(m) for m in metrics]
    return f"SELECT {', '.join(parts)} FROM {source} GROUP BY {keys}"


def profiled(source: str, scales: dict[str, int]) -> str:
    rows = []
    for c, s in scales.items():
        quartiles = ", ".join(
            f"{rounded(f'quantile_cont({c}::DOUBLE, {p})', s)} AS {n}"
            for n, p in (("p25", 0.25), ("median", 0.5), ("p75", 0.75))
        )
        rows.append(
            f"SELECT '{c}' AS variable_name, count(*) AS n, {rounded(f'min({c})::DOUBLE', s)} AS min_val,"
            f" {quartiles}, {rounded(f'sum({c})::DOUBLE / count({c})', s)} AS mean,"
            f" {rounded(f'max({c})::DOUBLE', s)} AS max_val,"
            f" {rounded(f'stddev_pop({c}::DOUBLE)', s)} AS std_dev FROM {source}"
        )
    return " UNION ALL ".join(rows)


def bucketed(source: str, value: str, edges, labels, name: str) -> str:
    pick = f"[{quoted(labels)}][1 + len(list_filter({doubles(edges)}, lambda e: coalesce({value}::DOUBLE, 1e18) >= e))]"
    return f"(SELECT *, {pick} AS {name} FROM {source})"


def compared(by: str, left: str, right: str) -> str:
    measures = ("requested_amount", "monthly_payment_proxy", "estimated_pd", "expected_loss_amount")
    sums = ", ".join(
        f"sum(x.{m})::DOUBLE AS base_{m}, sum(y.{m})::DOUBLE AS alt_{m},"
        f" (sum(y.{m}) - sum(x.{m}))::DOUBLE AS delta_{m}"
        for m in measures
    )
    return (
        f"SELECT x.{by} AS {by}, count(*) AS matched, 0::BIGINT AS only_base,"
        f" 0::BIGINT AS only_alt, {sums} FROM {left} x JOIN {right} y USING (application_seq)"
        f" GROUP BY x.{by}"
    )


def attributed(base: Scenario, alt: Scenario, factors: dict[str, tuple[str, ...]], measures: dict[str, int]) -> str:
    """Mean over all orders of what each factor's change adds, by the base scenario's product.

    ``measures`` gives the digits of each measure. Parts are differences of rounded running sums.
    """
    names = list(factors)
    parts, totals = [], []
    for mask in range(2 ** len(names)):
        fields = [f for i, n in enumerate(names) if mask >> i & 1 for f in factors[n]]
        s = replace(base, **{f: getattr(alt, f) for f in fields})
        parts.append(applications(s, f"_c{mask}"))
        units = ", ".join(f"sum(({m} * {10**d_})::HUGEINT) AS {m}" for m, d_ in measures.items())
        totals.append(
            f"SELECT {mask} AS mask, b.product_type, {', '.join(f'c.{m} AS {m}' for m in measures)}"
            f" FROM scored_c{mask} c JOIN scored_c0 b USING (application_seq)"
        )
        totals[-1] = f"SELECT mask, product_type, {units} FROM ({totals[-1]}) GROUP BY ALL"
    orders = list(permutations(range(len(names))))
    steps = []
    for i, name in enumerate(names):
        for order in orders:
            before = sum(1 << j for j in order[: order.index(i)])
            steps.append(f"({i}, '{name}', {before}, {before | 1 << i})")
    rows = " UNION ALL ".join(
        f"SELECT product_type, '{m}' AS measure, {10**d_} AS unit, mask, {m} AS v FROM totals" for m, d_ in measures.items()
    )
    n = len(orders)
    full = 2 ** len(names) - 1
    return f"""WITH {','.join(parts)},
totals AS ({' UNION ALL '.join(totals)}),
v AS ({rows}),
steps(i, factor, low, high) AS (VALUES {', '.join(steps)}),
part AS (SELECT a.product_type, a.measure, a.unit, i, factor, sum(b.v - a.v) AS p
  FROM steps JOIN v a ON a.mask = low JOIN v b ON b.mask = high AND b.product_type = a.product_type
    AND b.measure = a.measure GROUP BY ALL),
run AS (SELECT *, sum(p) OVER w AS s, sum(p) OVER w - p AS r FROM part
  WINDOW w AS (PARTITION BY product_type, measure ORDER BY i)),
up AS (SELECT *, sign(s) * ((2 * abs(s) + {n}) // {2 * n}) - sign(r) * ((2 * abs(r) + {n}) // {2 * n}) AS part FROM run)
SELECT up.product_type, up.measure, factor, a.v::DOUBLE / up.unit AS base_total, b.v::DOUBLE / up.unit AS alt_total,
  part::DOUBLE / up.unit AS contribution
FROM up JOIN v a ON a.mask = 0 AND a.product_type = up.product_type AND a.measure = up.measure
JOIN v b ON b.mask = {full} AND b.product_type = up.product_type AND b.measure = up.measure"""


def parameter_rules() -> str:
    """One row per customer and rule, from the columns that vary by customer."""
    varying = """
      SELECT c_name AS scenario_name, c_custkey AS k, c_acctbal::DECIMAL(18,2) AS bal,
        c_nationkey AS nat, (c_acctbal * 12)::DECIMAL(18,2) AS auto_min FROM customer"""
    broken = {
        "application_count": "k % 7 <= 1",
        "date_window": "k % 40 > 30",
        "product_mix": "k % 5 > 1",
        "score_mix": "k % 9 <> 0 AND (k % 3) * 290 <> (k % 6) * 145",
        "credit_score_bounds": "500 + (k % 11) * 40 >= 850",
        "income_bounds": "bal <= 0 OR bal >= 5000",
        "dti_bounds": "nat < 1 OR nat * 5 - 5 >= 70",
        "utilization_bounds": "nat <= 0 OR nat * 5 > 100",
        "amount_bounds": "auto_min >= 80000",
        "base_rates": "k % 10 = 0",
        "lgd_range": "k % 12 = 0 OR k % 12 >= 10",
        "no_null_parameter": "k % 9 = 0",
        "weights_not_negative": "k % 9 <> 0 AND k % 3 > 0",
        "amount_minimums_positive": "auto_min <= 0",
        "anchor_after_window": "k % 13 < 6",
        "ids_fit_width": "false",
    }
    rows = [
        f"SELECT scenario_name, '{rule}' AS rule, NOT ({test}) AS ok FROM v"
        for rule, test in broken.items()
    ]
    return f"WITH v AS ({varying}) " + " UNION ALL ".join(rows)


def expectation_rules(s: Scenario) -> str:
    targets = ", ".join(
        f"('{b}', {100 * float(getattr(s, w))!r}::DOUBLE, {i})"
        for i, (b, w) in enumerate(C.BAND_WEIGHT.items())
    )
    buckets = bucketed("scored", "payment_to_income_ratio", R.PTI_EDGES, R.PTI_LABELS, "pti_bucket")
    ranks = ", ".join(f"('{v}', {i})" for i, v in enumerate(R.PTI_LABELS))

    def wrong(source: str, label: str, value: str, rising: bool) -> str:
        sign, word = ("<", "rises") if rising else (">", "falls")
        return (
            f"SELECT '{value} {word} along {label}' AS rule, 0 AS most, count(*)::DOUBLE AS observed"
            f" FROM (SELECT {value} {sign} lag({value}) OVER (ORDER BY rank) AS w FROM {source})"
            " WHERE w"
        )

    falling = ("avg_credit_score", "avg_income")
    rising = (
        "avg_dti",
        "avg_utilization",
        "avg_delinquency_count",
        "major_derog_rate",
        "bankruptcy_rate",
        "avg_pti",
        "avg_pd",
    )
    rows = [
        "SELECT 'score_band share near target' AS rule, 1 AS most,"
        " max(abs(pct_of_total - target)) AS observed FROM bands",
        *[wrong("bands", "score_band", v, False) for v in falling],
        *[wrong("bands", "score_band", v, True) for v in rising],
        *[wrong("buckets", "pti_bucket", v, True) for v in ("avg_pd", "avg_expected_loss")],
        "SELECT 'estimated_pd at limit', 0.25,"
        " sum((estimated_pd >= 0.45)::INTEGER)::DOUBLE / count(*) FROM scored",
    ]
    return f"""
WITH {applications(s)},
bands AS (SELECT * FROM ({grouped('scored', ['score_band'], R.BAND_METRICS)})
  JOIN (VALUES {targets}) t(score_band, target, rank) USING (score_band)),
buckets AS (SELECT * FROM ({grouped(buckets, ['pti_bucket'], R.PTI_METRICS)})
  JOIN (VALUES {ranks}) t(pti_bucket, rank) USING (pti_bucket))
SELECT rule, observed <= most AS ok, observed FROM ({' UNION ALL '.join(rows)})"""


def statements(base: Scenario, stress: Scenario, tight: Scenario) -> dict[str, str]:
    one = f"WITH {applications(base)} "
    three = "WITH " + ",".join(
        [applications(base), applications(stress, "_s"), applications(tight, "_t")]
    )
    stacked = "({})".format(
        " UNION ALL ".join(
            f"SELECT scenario_name, product_type, application_id, score_band, requested_amount,"
            f" base_apr_for_payment_calc, monthly_payment_proxy, payment_to_income_ratio,"
            f" estimated_pd, estimated_lgd, expected_loss_amount FROM scored{t}"
            for t in ("", "_s", "_t")
        )
    )
    every = [n for n in APPLICATION_SCHEMA.names if n != "created_ts"]
    cells = ["product_type", "score_band"]
    pti = bucketed("scored", "payment_to_income_ratio", R.PTI_EDGES, R.PTI_LABELS, "pti_bucket")
    balance_labels = ("negative", "low", "middle", "high", "top")
    balance = bucketed("customer", "c_acctbal", (0, 2500, 5000, 7500), balance_labels, "balance_bucket")

    priority = "['MORTGAGE', 'REVOLVING_LINE', 'AUTO_LOAN', 'UNSECURED_PERSONAL_LOAN', 'HELOC'][substr(o_orderpriority, 1, 1)::INTEGER]"
    balance_band = (
        "CASE WHEN c_acctbal >= 7500 THEN 'SUPER_PRIME' WHEN c_acctbal >= 5000 THEN 'PRIME'"
        " WHEN c_acctbal >= 2500 THEN 'NEAR_PRIME' WHEN c_acctbal >= 0 THEN 'SUBPRIME' ELSE 'DEEP_SUBPRIME' END"
    )
    real = "WITH " + applications(
        base,
        source="orders LEFT JOIN customer ON c_custkey = o_custkey",
        carried="o_orderpriority, o_totalprice, o_orderdate, c_acctbal",
        labels=("o_orderdate::DATE", priority, balance_band),
    )

    def listed(*own: str, source: str = one, names: Iterable[str] = ()) -> str:
        return f"{source} SELECT {columns(['application_id', *own, *names])} FROM scored"

    def top(where: str, order: str) -> str:
        return (
            f"{one} SELECT {columns(every)} FROM scored WHERE {where}"
            f" ORDER BY {order}, application_id LIMIT 25"
        )

    split = chosen("u", ("train", "valid", "test"), (Decimal("0.8"), Decimal("0.9")))
    flags = ("major_derogatory", "bankruptcy", "prequalified", "returning_customer")
    digests = ", ".join(
        f"md5(application_id || '|{base.population_id}|{u}') AS h_{u}" for u in ("u1", "u8", "u15")
    )
    own = {
        "hash_digests": f"{one} SELECT application_id, {digests} FROM keys",
        "streamed_portfolio": listed("product_type", "requested_amount", "expected_loss_amount"),
        "hash_draws": f"{one} SELECT application_id, "
        + ", ".join(f"u{i}" for i in range(1, DRAWS + 1))
        + " FROM drawn",
        "keyed_ids": f"{one} SELECT application_seq, application_id, applicant_id FROM keys",
        "draw_category_mix": real + " SELECT o_orderpriority, kind, count(*) AS applications, sum(o_totalprice::DECIMAL(18,2))::DOUBLE AS price"
        f" FROM (SELECT *, {chosen('u2', C.PRODUCTS, cumulative(getattr(base, w) for w in C.PRODUCT_WEIGHT.values()))} AS kind"
        " FROM drawn) GROUP BY ALL",
        "draw_segments": listed(
            source=real,
            names=(
            "application_date",
            "product_type",
            "score_band",
            "credit_score",
            "loan_term_months",
            "base_amount",
            ),
        ),
        "draw_ladder": f"{real} SELECT score_band, delinquency_count_12m,"
        " count(*) AS applications FROM scored GROUP BY ALL",
        "draw_flags": real
        + grouped("scored", ["score_band"], [R.rate(f"{f}_rate", f"{f}_flag") for f in flags]),
        "borrower_profile": listed(
            source=real,
            names=(
            "annual_income",
            "debt_to_income_ratio",
            "utilization_rate",
            "tradeline_count",
            "months_since_oldest_trade",
            "recent_inquiry_count",
            "delinquency_count_12m",
            "major_derogatory_flag",
            "bankruptcy_flag",
            "prequalified_flag",
            "returning_customer_flag",
            ),
        ),
        "requested_amount": listed("product_type", "base_amount", "requested_amount"),
        "apr_bounds": listed("product_type", "apr_raw", "base_apr_for_payment_calc"),
        "payments": listed("loan_term_months", "monthly_payment_proxy"),
        "affordability": listed("amount_to_income_ratio", "payment_to_income_ratio"),
        "pd_components": listed("base_pd", *MULTIPLIERS),
        "expected_loss": f"{one} SELECT application_id, estimated_pd::DOUBLE AS estimated_pd,"
        " estimated_lgd::DOUBLE AS estimated_lgd,"
        " expected_loss_amount::DOUBLE AS expected_loss_amount,"
        " expected_loss_amount::DOUBLE AS recomputed_loss FROM scored",
        "scored_portfolio": f"{one} SELECT {columns(every)} FROM scored",
        "stored_portfolio": f"{three} SELECT scenario_name, population_id,"
        " count(*) AS applications, sum(expected_loss_amount)::DOUBLE AS expected_loss"
        " FROM (SELECT scenario_name, population_id, expected_loss_amount FROM scored UNION ALL"
        " SELECT scenario_name, population_id, expected_loss_amount FROM scored_s) GROUP BY ALL",
        "scenario_sweep": f"{three} SELECT "
        + columns(
            [
                "scenario_name",
                "application_id",
                "score_band",
                "requested_amount",
                "base_apr_for_payment_calc",
                "monthly_payment_proxy",
                "estimated_pd",
                "expected_loss_amount",
            ]
        )
        + f" FROM {stacked}",
        "scenario_totals": three
        + grouped(stacked, ["scenario_name", "product_type"], R.PRODUCT_METRICS, share=False),
        "scenario_compare": f"{three} " + compared("product_type", "scored", "scored_s"),
        "scenario_compare_by_band": f"{three} " + compared("score_band", "scored", "scored_t"),
        "param_violations": parameter_rules(),
        "output_checks": f"{one} SELECT 'row_count' AS rule, true AS ok,"
        " count(*)::VARCHAR AS observed FROM orders"
        + "".join(
            f" UNION ALL SELECT '{rule}', count(*) = 0, count(*)::VARCHAR FROM scored WHERE {test}"
            for rule, test in (
                ("application_id_present", "application_id IS NULL"),
                ("product_type_known", f"product_type NOT IN ({quoted(C.PRODUCTS)})"),
                ("score_band_known", f"score_band NOT IN ({quoted(C.BANDS)})"),
                ("estimated_pd_present", "estimated_pd IS NULL"),
            )
        ),
        "review_expectations": expectation_rules(base),
        "record_count": f"{one} SELECT count(*) AS application_count FROM scored",
        "portfolio_mix_product": one + grouped("scored", ["product_type"], ()),
        "portfolio_mix_band": one + grouped("scored", ["score_band"], ()),
        "variable_profile": one + profiled("scored", R.PROFILE_SCALES),
        "band_profile": one + grouped("scored", ["score_band"], R.BAND_METRICS),
        "product_profile": one + grouped("scored", ["product_type"], R.PRODUCT_METRICS),
        "pti_buckets": one + grouped(pti, ["pti_bucket"], R.PTI_METRICS),
        "product_band_matrix": one + grouped("scored", cells, R.CELL_METRICS, share=False),
        "risk_matrix": one + grouped("scored", cells, R.RISK_METRICS, share=False),
        "spot_strong_high_pti": top(
            "credit_score >= 700 AND payment_to_income_ratio >= 0.18",
            "payment_to_income_ratio DESC",
        ),
        "spot_weak_low_pti": top(
            "credit_score < 640 AND payment_to_income_ratio < 0.10",
            "credit_score DESC, payment_to_income_ratio",
        ),
        "spot_large_exposure": top(
            "requested_amount >= 250000 AND payment_to_income_ratio < 0.15",
            "requested_amount DESC",
        ),
        "head_sample": f"{one} SELECT {columns(every)} FROM scored ORDER BY application_id LIMIT 50",
        "hash_split_documents": f"SELECT lang, {split} AS split, count(*) AS documents,"
        " sum(n_chars)::BIGINT AS chars FROM (SELECT *, "
        f"{uniform('doc_id::VARCHAR', 'SPLIT_V1', 'u1')} AS u FROM documents) GROUP BY ALL",
        "lineitem_payments": f"""
WITH a AS (SELECT l_orderkey, l_linenumber,
    ['AUTO_LOAN', 'REVOLVING_LINE', 'HELOC'][1 + l_linenumber % 3] AS product_type,
    l_extendedprice::DECIMAL(18,2) AS amount,
    (0.05::DOUBLE + l_tax)::DECIMAL(12,6)::DOUBLE {MONTHLY} AS r,
    12 * (1 + l_partkey % 5) AS term, (l_quantity * 1000)::DECIMAL(18,2)::DOUBLE AS income
  FROM lineitem),
b AS (SELECT *, pow(1.0::DOUBLE + r, term::DOUBLE) AS g,
    (CASE product_type
      WHEN 'AUTO_LOAN' THEN (amount::DOUBLE * (r * g) / (g - 1.0::DOUBLE))::DECIMAL(18,2)
      WHEN 'REVOLVING_LINE' THEN round(amount * 0.03, 2)::DECIMAL(18,2)
      ELSE round(CAST(amount::DOUBLE * r AS DECIMAL(38,8)), 2)::DECIMAL(18,2) END)::DOUBLE
      AS payment FROM a)
SELECT l_orderkey, l_linenumber, product_type, payment,
  {exact_ratio('amount', 'income')} AS amount_ratio,
  {exact_ratio('payment', 'income', 12)} AS payment_ratio FROM b""",
        "lineitem_profile": profiled(
            "lineitem", {"l_quantity": 2, "l_extendedprice": 2, "l_discount": 4, "l_tax": 4}
        ),
        "lineitem_segments": grouped(
            "lineitem",
            ["l_returnflag", "l_linestatus"],
            (
                R.avg("avg_quantity", "l_quantity"),
                R.median("median_price", "l_extendedprice"),
                R.avg("avg_discount", "l_discount", 4),
                R.median("median_discount", "l_discount", 4),
            ),
        ),
        "orders_mix_priority": grouped("orders", ["o_orderpriority"], ()),
        "orders_top_price": "SELECT * REPLACE (strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate) FROM orders WHERE o_orderstatus = 'F'"
        " AND o_totalprice >= 1000 ORDER BY o_totalprice DESC, o_orderkey LIMIT 25",
        "customer_balance_buckets": grouped(
            balance,
            ["balance_bucket"],
            (R.avg("avg_balance", "c_acctbal"), R.median("median_balance", "c_acctbal")),
        ),
        "events_matrix": grouped(
            "(SELECT *, strftime(ts, '%Y-%m-%d') AS event_date FROM events)",
            ["event_type", "event_date"],
            (R.avg("avg_value", "value", 4),),
            share=False,
        ),
    }
    plain = "c_custkey::VARCHAR"
    u = {i: uniform(plain, "SEGMENT_V1", f"u{i}") for i in range(1, 8)}
    cents = "floor(({}) * 100.0::DOUBLE + 0.5::DOUBLE)::BIGINT / 100.0::DOUBLE"
    building = "c_mktsegment = 'BUILDING'"
    regions = [
        replace(
            base,
            scenario_name=f"REGION_{i}",
            rate_shift_bps=50 * i,
            max_income=Decimal(240000 - 30000 * i),
            lgd_auto=Decimal(45 + 5 * i) / 100,
            max_auto_amt=Decimal(80000 - 10000 * (i % 2)),
        )
        for i in range(5)
    ]
    by_region = " UNION ALL ".join(
        f"SELECT scenario_name, product_type, annual_income, base_apr_for_payment_calc, expected_loss_amount FROM scored_r{i}"
        for i in range(5)
    )
    factors = {
        "mix": ("pct_super_prime", "pct_prime", "pct_subprime", "pct_deep_subprime"),
        "amounts": ("max_mortgage_amt",),
        "lgd": ("lgd_revolving",),
    }
    own["scenario_attribution"] = attributed(
        base, tight, factors, {"requested_amount": 2, "monthly_payment_proxy": 2, "expected_loss_amount": 2}
    )
    own["scenario_table_totals"] = (
        "WITH " + ",".join(applications(r, f"_r{i}") for i, r in enumerate(regions))
        + f" SELECT scenario_name, product_type, count(*) AS applications, sum(annual_income)::DOUBLE AS income,"
        " sum(base_apr_for_payment_calc)::DOUBLE AS apr, sum(expected_loss_amount)::DOUBLE AS expected_loss"
        f" FROM ({by_region}) GROUP BY ALL"
    )
    added = applications(base, "_k", "c_custkey + 50000000", "customer")
    own["shared_portfolio"] = (
        f"WITH {applications(base)}, {applications(stress, '_s')}, {added}"
        " SELECT scenario_name, product_type, count(*) AS applications, sum(expected_loss_amount)::DOUBLE AS expected_loss"
        " FROM (SELECT scenario_name, product_type, expected_loss_amount FROM scored"
        " UNION ALL SELECT scenario_name, product_type, expected_loss_amount FROM scored_s"
        " UNION ALL SELECT scenario_name, product_type, expected_loss_amount FROM scored_k) GROUP BY ALL"
    )
    own["mix_fits_targets"] = one + " UNION ALL ".join(
        f"SELECT '{label} mix fits its targets' AS rule, sum(x) <= {d(X.chi_square_limit(4, 0.001))} AS ok,"
        f" round(sum(x), 6) AS observed FROM (SELECT pow(count(*) FILTER ({label} = k) - count(*) * p, 2) / (count(*) * p) AS x"
        f" FROM scored, (VALUES {', '.join(f'({chr(39)}{k}{chr(39)}, {d(getattr(base, w))})' for k, w in weights.items())}) t(k, p)"
        " GROUP BY k, p)"
        for label, weights in (("product_type", C.PRODUCT_WEIGHT), ("score_band", C.BAND_WEIGHT))
    )
    both = " UNION ALL ".join(f"SELECT {', '.join(R.PROFILE_SCALES)} FROM scored{t}" for t in ("", "_k"))
    own["sketched_profile"] = f"WITH {applications(base)}, {added}, every AS ({both}) " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable_name, count({c}) AS n, min({c})::DOUBLE AS min_val, max({c})::DOUBLE AS max_val,"
        f" {rounded(f'sum({c})::DOUBLE / count({c})', s)} AS mean, true AS near FROM every"
        for c, s in R.PROFILE_SCALES.items()
    )
    own["lineitem_scorecard"] = """
WITH p AS (SELECT l_orderkey, l_linenumber, l_extendedprice,
    CASE WHEN l_discount < 0.02 THEN 0.90 WHEN l_discount < 0.05 THEN 1.00 WHEN l_discount < 0.08 THEN 1.15 ELSE 1.40 END AS discount,
    CASE WHEN l_quantity < 5 THEN 1.20 WHEN l_quantity < 20 THEN 1.05 WHEN l_quantity < 40 THEN 1.00 ELSE 0.95 END AS quantity,
    CASE WHEN datediff('day', DATE '1995-01-01', l_shipdate::DATE) < 0 THEN 1.30 WHEN datediff('day', DATE '1995-01-01', l_shipdate::DATE) < 365
      THEN 1.10 ELSE 1.00 END AS age,
    CASE l_returnflag WHEN 'R' THEN 0.14 WHEN 'A' THEN 0.06 ELSE 0.025 END AS base,
    CASE l_linestatus WHEN 'F' THEN 0.45 ELSE 0.70 END AS lgd FROM lineitem),
q AS (SELECT *, floor(least(0.45::DOUBLE, greatest(0.005::DOUBLE, base::DOUBLE * discount::DOUBLE * quantity::DOUBLE * age::DOUBLE))
    * 1000000.0::DOUBLE + 0.5::DOUBLE) / 1000000.0::DOUBLE AS pd FROM p)
SELECT l_orderkey, l_linenumber, discount::DOUBLE AS points_discount, quantity::DOUBLE AS points_quantity, age::DOUBLE AS points_age,
  pd, round(l_extendedprice::DECIMAL(20,2) * pd::DECIMAL(7,6) * lgd::DECIMAL(7,6), 2)::DOUBLE AS loss FROM q"""
    own["customer_draws"] = f"""
SELECT c_custkey, c_mktsegment,
  floor(least(c_acctbal + 5000.0::DOUBLE, greatest(-500.0::DOUBLE, CASE WHEN {building} THEN -1000.0::DOUBLE + pow({u[1]}, 0.65::DOUBLE) * 8000.0::DOUBLE
    ELSE 500.0::DOUBLE + {u[1]} * 9000.0::DOUBLE END)) * 100.0::DOUBLE + 0.5::DOUBLE)::BIGINT / 100.0::DOUBLE AS balance,
  floor(least(0.7::DOUBLE, greatest(0.05::DOUBLE, CASE WHEN {building} THEN 0.18::DOUBLE + {u[2]} * 0.22::DOUBLE
    ELSE 0.3::DOUBLE + {u[2]} * 0.25::DOUBLE END + CASE WHEN {u[3]} < 0.08 THEN 0.15::DOUBLE ELSE 0.0::DOUBLE END
    - CASE WHEN {u[3]} > 0.93 THEN 0.10::DOUBLE ELSE 0.0::DOUBLE END)) * 10000.0::DOUBLE + 0.5::DOUBLE)::BIGINT / 10000.0::DOUBLE AS share,
  least(25, greatest(1, CASE WHEN {building} THEN floor(6 + {u[4]} * 12)::INT + CASE WHEN {u[5]} > 0.93 THEN 8 ELSE 0 END
    ELSE floor(1 + {u[4]} * 8)::INT + CASE WHEN {u[5]} > 0.98 THEN 7 ELSE 0 END END)) AS lines
FROM customer"""
    more = {
        "report_files": own["portfolio_mix_product"],
        "bucketed_compare": own["scenario_compare"],
        "spot_scored_keys": own["spot_large_exposure"],
        "key_table_totals": "SELECT n AS keys, 1::BIGINT AS first_key, n AS last_key,"
        " (n * (n + 1) // 2)::BIGINT AS key_sum FROM (SELECT count(*) AS n FROM orders)",
        "created_on_every_row": "SELECT count(*) AS applications, count(*) AS created FROM orders",
        "key_checks": "SELECT rule, n = 0 AS ok, n::VARCHAR AS observed FROM (SELECT unnest(['key_present', 'key_not_negative', 'key_fits_width',"
        " 'key_unique']) AS rule, unnest([count(*) FILTER (o_custkey IS NULL), count(*) FILTER (o_custkey < 0),"
        " count(*) FILTER (o_custkey > 99999999), count(o_custkey) - count(DISTINCT o_custkey)]) AS n"
        " FROM orders)",
        "ranked_products": f"{one} SELECT product_type, n AS applications,"
        " row_number() OVER (ORDER BY n DESC, product_type) AS place"
        " FROM (SELECT product_type, count(*) AS n FROM scored GROUP BY ALL)",
        "segment_draws": f"""SELECT c_custkey, c_mktsegment,
  CASE WHEN {building} THEN floor(10 + {u[1]} * 5)::INT ELSE floor(100 + {u[1]} * 50)::INT END AS visits,
  CASE WHEN {building} THEN {cents.format(f"100.0::DOUBLE + {u[2]} * 900.0::DOUBLE")}
    ELSE {cents.format(f"5.0::DOUBLE + {u[2]} * 15.0::DOUBLE")} END AS budget,
  CASE c_mktsegment WHEN 'BUILDING' THEN [12, 24, 36][1 + floor({u[3]} * 3)::INT]
    WHEN 'MACHINERY' THEN [6, 48][1 + floor({u[3]} * 2)::INT] END AS months,
  CASE WHEN {building} THEN CASE WHEN {u[4]} < 0.5 THEN 0 WHEN {u[4]} < 0.8 THEN 1 ELSE 2 END
    ELSE CASE WHEN {u[4]} < 0.9 THEN 0 ELSE 3 END END AS claims,
  {u[5]} < CASE WHEN {building} THEN 0.25::DOUBLE ELSE 0.5::DOUBLE END AS sampled,
  {u[6]} < 0.1::DOUBLE AS audited,
  coalesce(CASE WHEN {u[6]} < 0.1::DOUBLE THEN {u[7]} < CASE WHEN {building} THEN 0.9::DOUBLE ELSE 0.6::DOUBLE END
    ELSE false END, false) AS confirmed
FROM customer""",
    }
    return own | more
