"""The registered queries as SQL for an independent engine, in their literal form.

Rollups aggregate the two directions apart and full-join them, prices divide plain sums, and the statistics
spell out their arithmetic, so none of the shortcuts of the Spark plans is repeated here. Quantities are added as
decimals without rounding.
"""

from __future__ import annotations

TRADE = """
trade AS (
  SELECT
    CASE WHEN l_returnflag = 'A' THEN 1 WHEN l_returnflag = 'N' THEN 2 WHEN l_linestatus = 'O' THEN 1 ELSE 3 END
      AS trade_id,
    CASE bk WHEN 0 THEN NULL WHEN 1 THEN '2207100000' WHEN 2 THEN '2208700000' WHEN 3 THEN '2203000000'
            WHEN 4 THEN '1004900000' WHEN 5 THEN '2304000000' WHEN 6 THEN '2714900000'
            ELSE concat(lpad(CAST(101 + (l_partkey % 97) * 20 AS VARCHAR), 4, '0'),
                        lpad(CAST(l_partkey % 7 AS VARCHAR), 6, '0')) END AS hts_code,
    CASE WHEN p_size % 25 = 0 THEN NULL ELSE p_size % 2 END AS agri_prod,
    CASE n_nationkey WHEN 23 THEN NULL WHEN 24 THEN 'united states' ELSE lower(n_name) END AS country,
    CASE l_partkey % 8 WHEN 0 THEN NULL WHEN 1 THEN '3254' WHEN 2 THEN '3256' WHEN 3 THEN '3341' WHEN 4 THEN '3391'
                       WHEN 5 THEN '1111' WHEN 6 THEN '2123' ELSE '3111' END AS naics,
    CAST(floor(l_extendedprice) AS BIGINT) AS data,
    CASE WHEN bk = 4 THEN CASE WHEN l_linenumber % 2 = 0 THEN 't' ELSE 'T' END
         ELSE CASE l_orderkey % 10 WHEN 0 THEN 'kg' WHEN 1 THEN 'KG' WHEN 2 THEN 'gm' WHEN 3 THEN 't' WHEN 4 THEN 'l'
                                   WHEN 5 THEN 'doz' WHEN 6 THEN 'm3' WHEN 7 THEN 'pfl' WHEN 8 THEN 'no' ELSE NULL END
         END AS unit_1,
    CASE WHEN bk = 5 AND year(date) = 2007 AND month(date) = 3 THEN 7540542599
         WHEN bk = 6 AND year(date) = 2008 AND month(date) = 6 THEN 5000000
         WHEN l_linenumber = 7 AND l_orderkey % 5 = 0 THEN NULL
         ELSE CAST(floor(l_quantity) AS BIGINT) END AS qty_1,
    CASE l_linenumber WHEN 1 THEN 'kg' WHEN 2 THEN 'gm' WHEN 3 THEN 't' WHEN 4 THEN 'l' WHEN 5 THEN 'pfl'
                      WHEN 6 THEN 'No' ELSE NULL END AS unit_2,
    CASE WHEN l_orderkey % 11 = 0 THEN NULL ELSE CAST(floor(l_quantity) AS BIGINT) * 2 END AS qty_2,
    date
  FROM (
    SELECT *, l_partkey % 40 AS bk,
           CASE WHEN l_orderkey % 997 = 0 THEN NULL ELSE l_shipdate + INTERVAL '12' YEAR END AS date
    FROM lineitem
    LEFT JOIN part ON l_partkey = p_partkey
    LEFT JOIN supplier ON l_suppkey = s_suppkey
    LEFT JOIN nation ON s_nationkey = n_nationkey))
"""



def moved(date: str) -> str:
    """The records with their dates replaced."""
    return TRADE.replace("trade AS (", "plain AS (", 1) + f", trade AS (SELECT * REPLACE ({date} AS date) FROM plain)"


CORRECTED = """
corrected AS (
  SELECT * REPLACE (
    CASE WHEN year(date) = 2007 AND month(date) = 3 AND qty_1 = 7540542599 AND hts_code = '2304000000' THEN 10648031
         WHEN year(date) = 2008 AND month(date) = 6 AND qty_1 = 5000000 AND hts_code = '2714900000' THEN 50000
         ELSE qty_1 END AS qty_1,
    CASE WHEN year(date) BETWEEN 2012 AND 2017 AND unit_1 = 't' AND country <> 'united states'
              AND hts_code = '1004900000' THEN 'kg' ELSE unit_1 END AS unit_1)
  FROM {source})
"""

# Units, their order and their factors.
CONVERTED = """
converted AS (
  SELECT * REPLACE (coalesce(qty_1, 0) AS qty_1, coalesce(qty_2, 0) AS qty_2),
    CASE WHEN lower(unit_1) = 'kg' THEN coalesce(qty_1, 0)::DOUBLE
         WHEN lower(unit_2) = 'kg' THEN coalesce(qty_2, 0)::DOUBLE
         WHEN lower(unit_1) = 'gm' THEN coalesce(qty_1, 0)::DOUBLE / 1000
         WHEN lower(unit_2) = 'gm' THEN coalesce(qty_2, 0)::DOUBLE / 1000
         WHEN lower(unit_1) = 't' THEN coalesce(qty_1, 0)::DOUBLE * 1000
         WHEN lower(unit_2) = 't' THEN coalesce(qty_2, 0)::DOUBLE * 1000
         WHEN lower(unit_1) = 'l' THEN coalesce(qty_1, 0)::DOUBLE
         WHEN lower(unit_2) = 'l' THEN coalesce(qty_2, 0)::DOUBLE
         WHEN lower(unit_1) = 'doz' THEN coalesce(qty_1, 0)::DOUBLE * 0.70874::DOUBLE
         WHEN lower(unit_2) = 'doz' THEN coalesce(qty_2, 0)::DOUBLE * 0.70874::DOUBLE
         WHEN lower(unit_1) = 'm3' THEN coalesce(qty_1, 0)::DOUBLE * 353.8322::DOUBLE
         WHEN lower(unit_2) = 'm3' THEN coalesce(qty_2, 0)::DOUBLE * 353.8322::DOUBLE
         WHEN lower(unit_1) = 'pfl' AND hts_code[:6] = '220710' THEN coalesce(qty_1, 0)::DOUBLE * 0.5556::DOUBLE
         WHEN lower(unit_2) = 'pfl' AND hts_code[:6] = '220710' THEN coalesce(qty_2, 0)::DOUBLE * 0.5556::DOUBLE
         WHEN lower(unit_1) = 'pfl' AND hts_code[:6] = '220870' THEN coalesce(qty_1, 0)::DOUBLE * 2
         WHEN lower(unit_2) = 'pfl' AND hts_code[:6] = '220870' THEN coalesce(qty_2, 0)::DOUBLE * 2
         WHEN lower(unit_1) = 'pfl' THEN coalesce(qty_1, 0)::DOUBLE * 1.25::DOUBLE
         WHEN lower(unit_2) = 'pfl' THEN coalesce(qty_2, 0)::DOUBLE * 1.25::DOUBLE END AS qty,
CASE WHEN lower(unit_1) = 'kg' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 1::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'kg' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 1::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'gm' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 0.001::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'gm' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 0.001::DECIMAL(9, 5)
         WHEN lower(unit_1) = 't' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 1000::DECIMAL(9, 5)
         WHEN lower(unit_2) = 't' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 1000::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'l' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 1::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'l' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 1::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'doz' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 0.70874::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'doz' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 0.70874::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'm3' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 353.8322::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'm3' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 353.8322::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'pfl' AND hts_code[:6] = '220710' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 0.5556::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'pfl' AND hts_code[:6] = '220710' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 0.5556::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'pfl' AND hts_code[:6] = '220870' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 2::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'pfl' AND hts_code[:6] = '220870' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 2::DECIMAL(9, 5)
         WHEN lower(unit_1) = 'pfl' THEN coalesce(qty_1, 0)::DECIMAL(19, 0) * 1.25::DECIMAL(9, 5)
         WHEN lower(unit_2) = 'pfl' THEN coalesce(qty_2, 0)::DECIMAL(19, 0) * 1.25::DECIMAL(9, 5) END AS exact_qty,
    quarter(date)::INTEGER AS qtr,
    (CASE WHEN month(date) > 6 THEN year(date) + 1 ELSE year(date) END)::INTEGER AS fiscal_year,
    month(date)::INTEGER AS month, year(date)::INTEGER AS year
  FROM {source})
"""

KEYS = {
    "yearly": ["year"], "fiscal": ["fiscal_year"], "qtr": ["year", "qtr"], "monthly": ["year", "month"],
    "total": [], "hts": ["hts_code"], "naics": ["naics"], "country": ["country"],
}


def divide(x: str, y: str) -> str:
    return (
        f"CASE WHEN {y} = 0 THEN CASE WHEN {x} = 0 THEN 'nan'::DOUBLE WHEN {x} > 0 THEN 'inf'::DOUBLE "
        f"ELSE '-inf'::DOUBLE END ELSE ({x}) / ({y}) END"
    )


def rollup_ctes(level: str, time: str, where: str = "true", corrections: bool = False, records: str = TRADE) -> str:
    """CTEs up to `netted`, with exact sums in `rolled`. `where` filters the raw records."""
    code = KEYS[level][0] + " IS NOT NULL" if level != "total" else "true"
    keys = ", ".join(KEYS[time] + KEYS[level])

    def side(trade_id: int, name: str) -> str:
        return (
            f"SELECT {keys}, sum(data)::BIGINT AS {name}, sum(exact_qty) AS {name}_qty FROM converted "
            f"WHERE trade_id = {trade_id} AND hts_code IS NOT NULL GROUP BY {keys}"
        )

    source = "corrected" if corrections else "wanted"
    return ", ".join([
        records,
        f"wanted AS (SELECT * FROM trade WHERE {code} AND {where})",
        *([CORRECTED.format(source="wanted")] if corrections else []),
        CONVERTED.format(source=source),
        f"i AS ({side(1, 'imports')})",
        f"e AS ({side(2, 'exports')})",
        f"""rolled AS (
          SELECT {keys}, coalesce(imports, 0) AS imports, coalesce(imports_qty, 0) AS imports_qty,
                 coalesce(exports, 0) AS exports, coalesce(exports_qty, 0) AS exports_qty
          FROM i FULL JOIN e USING ({keys}))""",
        """doubled AS (
          SELECT * REPLACE (imports_qty::DOUBLE AS imports_qty, exports_qty::DOUBLE AS exports_qty) FROM rolled),
        netted AS (
          SELECT *, exports - imports AS net_exports, imports - exports AS net_imports,
                 exports_qty - imports_qty AS net_exports_qty, imports_qty - exports_qty AS net_imports_qty
          FROM doubled)""",
    ])


def rollup_sql(level: str, time: str, where: str = "true", corrections: bool = False, records: str = TRADE) -> str:
    keys = ", ".join(f"{k} NULLS FIRST" for k in KEYS[time] + KEYS[level])
    return f"WITH {rollup_ctes(level, time, where, corrections, records)} SELECT * FROM netted ORDER BY {keys}"


def price_ctes(time: str, where: str = "true", records: str = TRADE) -> str:
    """CTEs up to `prices` with one row per heading and period."""
    period, start = ("qtr", "(qtr - 1) * 3 + 1") if time == "qtr" else ("month", "month")
    guarded = "CASE WHEN {0} = 0 THEN 1 ELSE {0} END"
    return ", ".join([
        rollup_ctes("hts", time, where, corrections=True, records=records),
        f"""headings AS (
          SELECT year, {period}, hts_code[:4] AS hs4, sum(imports)::BIGINT AS imports, sum(exports)::BIGINT AS exports,
                 sum({guarded.format('imports_qty')})::DOUBLE AS imports_qty,
                 sum({guarded.format('exports_qty')})::DOUBLE AS exports_qty
          FROM rolled GROUP BY ALL)""",
        f"""prices AS (
          SELECT *, imports / imports_qty AS price_imports, exports / exports_qty AS price_exports,
                 make_timestamp(year, {start}, 1, 0, 0, 0.0) AS date
          FROM headings)""",
    ])


def changes(previous: str, names=("price_imports", "price_exports")) -> str:
    """Select list: percentage change of both prices against `previous`, a column pattern."""
    return ", ".join(f"({divide(f'{n} - {previous.format(n)}', previous.format(n))}) * 100 AS {n}_yoy" for n in names)


def lagged(rows: int, names=("price_imports", "price_exports")) -> str:
    return ", ".join(
        f"lag({n}, {rows}) OVER (PARTITION BY hs4 ORDER BY date NULLS FIRST) AS {n}_lag{rows}" for n in names
    )


def price_changes_ctes(where: str = "true", records: str = TRADE) -> str:
    return ", ".join([
        price_ctes("qtr", where, records),
        f"lags AS (SELECT *, {lagged(4)} FROM prices)",
        f"series AS (SELECT * EXCLUDE (price_imports_lag4, price_exports_lag4), {changes('{}_lag4')} FROM lags)",
    ])


def price_sql(where: str = "true") -> str:
    return f"WITH {price_changes_ctes(where)} SELECT * FROM series ORDER BY hs4, date NULLS FIRST"


PRICE_CALENDAR = f"""
WITH {price_ctes("qtr")}
SELECT now.*, {", ".join(
    f"({divide(f'now.{p} - ago.{p}', f'ago.{p}')}) * 100 AS {p}_yoy" for p in ("price_imports", "price_exports"))}
FROM prices now LEFT JOIN prices ago ON now.hs4 = ago.hs4 AND now.year - 1 = ago.year AND now.qtr = ago.qtr
"""

MOVERS = """
WITH {ctes},
latest AS (
  SELECT *, price_{side}_yoy AS actual_yoy,
         CASE WHEN price_{side}_yoy < -100 THEN -100 WHEN isnan(price_{side}_yoy) THEN price_{side}_yoy
              WHEN price_{side}_yoy > 100 THEN 100 ELSE price_{side}_yoy END AS plot_yoy
  FROM series WHERE date = (SELECT max(date) FROM series))
SELECT *, row_number() OVER (ORDER BY actual_yoy {order}, hs4)::INTEGER AS position
FROM latest WHERE {where} QUALIFY position <= 50
"""


def movers_sql(order: str, side: str = "imports", where: str = "true", records: str = TRADE) -> str:
    return MOVERS.format(ctes=price_changes_ctes(records=records), order=order, side=side, where=where)


LATEST_PERIOD = f"WITH {price_changes_ctes()} SELECT * FROM series WHERE date = (SELECT max(date) FROM series)"


def price_statistics_sql(columns: str = "", months: bool = False, records: str = TRADE) -> str:
    """Mean and deviation of three rows are written out: m is the running mean, s the running sum of squares. With `months`,
    the earlier rows are looked up by their month instead."""
    both = ("imports", "exports")
    price = [f"price_{d}" for d in both]
    mean, spread, band, shift = [], [], [], []
    for p in price:
        a, b, c = f"{p}_lag2", f"{p}_lag1", p
        mean.append(f"CASE WHEN complete THEN ({a} + {b} + {c}) / 3 END AS {p}_mean")
        m2 = f"({a} + ({b} - {a}) / 2)"
        s2 = f"(({b} - {a}) * (({b} - {a}) - ({b} - {a}) / 2))"
        s3 = f"({s2} + ({c} - {m2}) * (({c} - {m2}) - ({c} - {m2}) / 3))"
        spread.append(f"CASE WHEN complete THEN sqrt({s3} / 2) END AS {p}_std")
        band.append(f"{p}_mean - {p}_std * 2 AS {p}_low, {p}_mean + {p}_std * 2 AS {p}_high")
    for d in both:
        shift.append(f"rank_{d}_lag12 - rank_{d} AS rank_{d}_shift")
    ranks = ", ".join(
        f"rank() OVER (PARTITION BY year, month ORDER BY price_{d} DESC)::INTEGER AS rank_{d}" for d in both
    )
    ranked = tuple(f"rank_{d}" for d in both)
    if months:
        lags = ", ".join([
            *(f"p{n}.{p} AS {p}_lag{n}" for p in price for n in (1, 2, 12)), *(f"p12.{r} AS {r}_lag12" for r in ranked),
            "p1.hs4 IS NOT NULL AND p2.hs4 IS NOT NULL AS complete"])
        joins = " ".join(
            f"LEFT JOIN ranked p{n} ON now.hs4 = p{n}.hs4 AND now.year * 12 + now.month - {n} = p{n}.year * 12 + p{n}.month"
            for n in (1, 2, 12))
        lagging = f"SELECT now.*, {lags} FROM ranked now {joins}"
    else:
        lags = ", ".join([
            lagged(1), lagged(2), lagged(12), lagged(12, ranked),
            "row_number() OVER (PARTITION BY hs4 ORDER BY date NULLS FIRST) >= 3 AS complete",
        ])
        lagging = f"SELECT *, {lags} FROM ranked"
    helpers = ", ".join([*(f"{p}_lag{n}" for p in price for n in (1, 2, 12)), *(f"rank_{d}_lag12" for d in both), "complete"])
    return f"""
    WITH {price_ctes("monthly", records=records)},
    ranked AS (SELECT *, {ranks} FROM prices),
    lags AS ({lagging}),
    stats AS (SELECT *, {", ".join(mean + spread)} FROM lags),
    everything AS (
      SELECT * EXCLUDE ({helpers}), {", ".join(band)}, {changes("{}_lag12")}, {", ".join(shift)} FROM stats)
    SELECT {f"hs4, year, month, {columns}" if columns else "*"} FROM everything
    """


FISCAL_NET = f"""
WITH {rollup_ctes("hts", "fiscal")},
clamped AS (
  SELECT fiscal_year, CASE WHEN imports_qty < exports_qty THEN 0 ELSE imports_qty - exports_qty END AS net FROM rolled)
SELECT fiscal_year, sum(net)::DOUBLE AS net_qty FROM clamped GROUP BY fiscal_year
"""

UNIT_CONVERSION = f"""
WITH {TRADE}, {CONVERTED.format(source="trade")}
SELECT hts_code, unit_1, qty_1, unit_2, qty_2, qty FROM converted
"""

DATE_DIMS = f"""
WITH {TRADE}, {CONVERTED.format(source="trade")}
SELECT date, qtr, fiscal_year, month, year FROM converted
"""

CORRECTIONS = f"""
WITH {TRADE}, {CORRECTED.format(source="trade")}
SELECT date, hts_code, country, unit_1, qty_1 FROM corrected
"""

CHAPTERS = f"""
WITH {TRADE}
SELECT DISTINCT left(hts_code::BIGINT::VARCHAR, 2) AS cmdcode FROM trade ORDER BY cmdcode NULLS FIRST OFFSET 2
"""

UNION_DIRECTIONS = f"""
WITH {TRADE}
SELECT trade_id, hts_code, data, date FROM trade WHERE trade_id = 1
UNION ALL SELECT trade_id, hts_code, data, date FROM trade WHERE trade_id = 2
"""

HEADER_UNION = f"""
WITH {TRADE}
SELECT hts_code AS "CODE", CASE WHEN data % 5 <> 0 THEN data::VARCHAR END AS "VAL",
       CASE WHEN data % 2 = 1 THEN unit_1 END AS "UNIT"
FROM trade
"""

HEADER_ROWS = f"""SELECT "CODE", "VAL" FROM ({HEADER_UNION})"""

AGRI_FLAG = f"""
WITH {TRADE}
SELECT hts_code, data,
  (hts_code[:4] IN (
    '0106', '0201', '0202', '0203', '0204', '0206', '0207', '0208', '0209', '0210', '0301', '0302', '0303', '0304',
    '0305', '0306', '0307', '0401', '0402', '0403', '0404', '0405', '0406', '0407', '0408', '0409', '0410', '0701',
    '0702', '0703', '0704', '0705', '0706', '0707', '0708', '0709', '0710', '0711', '0712', '0713', '0714', '0801',
    '0802', '0803', '0804', '0805', '0806', '0807', '0808', '0809', '0810', '0811', '0813', '0901', '0902', '0904',
    '0905', '0906', '0907', '0908', '0909', '0910', '1001', '1004', '1005', '1006', '1008', '1101', '1102', '1103',
    '1104', '1105', '1106', '1107', '1108', '1109', '1202', '1206', '1207', '1209', '1211', '1212', '1214', '1301',
    '1302', '1501', '1502', '1504', '1507', '1508', '1509', '1510', '1511', '1512', '1513', '1514', '1515', '1516',
    '1517', '1518', '1601', '1602', '1604', '1605', '1701', '1702', '1704', '1804', '1805', '1806', '1901', '1902',
    '1904', '1905', '2001', '2002', '2003', '2004', '2005', '2006', '2007', '2008', '2009', '2101', '2102', '2103',
    '2104', '2105', '2106'))::INTEGER AS agricultural
FROM trade
"""

# Prefixes of the codes made here, and all sector labels.
NAICS_SECTOR = f"""
WITH {TRADE}, made AS (
  SELECT data, CASE WHEN data % 37 <> 0 THEN [
    '11', '21', '31', '32', '33', '311', '312', '313', '314', '315', '316', '321', '322', '323', '324', '325', '3254',
    '326', '327', '331', '332', '333', '334', '3341', '335', '336', '337', '339', '3391', '99', '2'][data % 31 + 1]
    || (data % 10)::VARCHAR END AS naics
  FROM trade),
sectors(prefix, sector) AS (VALUES
  ('11', 'Agrivultura, silvicultura, pesca y caza'), ('21', 'Minería'), ('31', 'Manufactura'), ('32', 'Manufactura'),
  ('33', 'Manufactura'), ('311', 'Alimentos'), ('312', 'Productos de bebidads y tabaco'), ('313', 'Textiles'),
  ('314', 'Textiles'), ('315', 'Ropa'), ('316', 'Cuero y productos  de afines'), ('321', 'Productos de madera'),
  ('322', 'Papel'), ('323', 'Imprenta'), ('324', 'Productos de petróleo y carbón'), ('325', 'Químicos'),
  ('3254', 'Farmacéuticos y medicinas'), ('326', 'Productos de plástico y de goma'),
  ('327', 'Productos minerales no metálicos'), ('331', 'Metales primarios'), ('332', 'productos fabricados de metal'),
  ('333', 'Maquinaria'), ('334', 'Equipo de computación y productos electrónicos'),
  ('3341', 'Computadoras y equipo periférico'), ('335', 'Equipo eléctrico, enseres, y componetes'),
  ('336', 'Equipo de transporte'), ('337', 'Muebles y productos relacionados'), ('339', 'Manufacturas misceláneas'),
  ('3391', 'Equipos y materiales de uso médico')),
best AS (
  SELECT naics, max_by(sector, length(prefix)) AS sector
  FROM (SELECT DISTINCT naics FROM made) JOIN sectors ON starts_with(naics, prefix) GROUP BY naics)
SELECT m.naics, b.sector, m.data FROM made m LEFT JOIN best b ON m.naics = b.naics
"""

STAR_TRADE = """
trade AS (
  SELECT l_shipdate AS date, l_linenumber % 3 AS trade_id, lpad(p.p_partkey::VARCHAR, 10, '0') AS hts_code,
         floor(l_extendedprice)::BIGINT AS data, (3110 + r.r_regionkey)::VARCHAR AS naics,
         ['kg', 'gm', 't', 'l', 'doz', 'm3', 'pfl', 'no'][u1.n_nationkey + 1] AS unit_1, floor(l_quantity)::BIGINT AS qty_1,
         ['kg', 'gm', 't', 'l', 'doz', 'm3', 'pfl', 'no'][u2.n_nationkey + 1] AS unit_2, floor(l_quantity)::BIGINT * 2 AS qty_2
  FROM lineitem
  LEFT JOIN part p ON (CASE WHEN l_orderkey % 13 <> 0 THEN l_partkey END) = p.p_partkey
  LEFT JOIN region r ON l_linenumber = r.r_regionkey
  LEFT JOIN nation u1 ON l_orderkey % 9 = u1.n_nationkey
  LEFT JOIN nation u2 ON l_linenumber = u2.n_nationkey)
"""

STAR = """
SELECT l_shipdate AS date, lower(n.n_name) AS country, l_linenumber % 3 AS trade_id, p.p_size % 2 AS agri_prod,
       lpad(p.p_partkey::VARCHAR, 10, '0') AS hts_code, p.p_name AS hts_desc,
       floor(l_extendedprice)::BIGINT AS data, s.s_name AS sitc, r.r_name AS naics,
       u1.n_name AS unit_1, floor(l_quantity)::BIGINT AS qty_1, u2.n_name AS unit_2, floor(l_quantity)::BIGINT * 2 AS qty_2,
       CASE l_linenumber % 3 WHEN 1 THEN 'Imports' WHEN 2 THEN 'Exports' END AS direction, d.r_name AS district
FROM lineitem
LEFT JOIN nation n ON l_suppkey % 27 = n.n_nationkey
LEFT JOIN part p ON (CASE WHEN l_orderkey % 13 <> 0 THEN l_partkey END) = p.p_partkey
LEFT JOIN supplier s ON l_suppkey + 5 = s.s_suppkey
LEFT JOIN region r ON l_linenumber = r.r_regionkey
LEFT JOIN region d ON l_linenumber - 1 = d.r_regionkey
LEFT JOIN nation u1 ON l_orderkey % 30 = u1.n_nationkey
LEFT JOIN nation u2 ON l_linenumber = u2.n_nationkey
"""

PREFIX_LABEL = """
WITH prefixes AS (
  SELECT left(lpad((p_partkey * 245489 % 100000000)::VARCHAR, 8, '0'), 2 + (p_partkey % 6)::INTEGER) AS prefix, min(p_name) AS label
  FROM part GROUP BY ALL),
coded AS (
  SELECT l_orderkey, CASE WHEN l_orderkey % 37 <> 0 THEN
    lpad((l_partkey * 245489 % 100000000)::VARCHAR, 8, '0') || l_linenumber::VARCHAR END AS code FROM lineitem),
best AS (
  SELECT code, max_by(label, length(prefix)) AS label
  FROM (SELECT DISTINCT code FROM coded) JOIN prefixes ON starts_with(code, prefix) GROUP BY code)
SELECT c.code, l_orderkey, label FROM coded c LEFT JOIN best b ON c.code = b.code
"""


def layouts_sql() -> str:
    """Sixteen rollups under each other."""
    def column(name: str, keys: list[str], kind: str) -> str:
        return f"{name if name in keys else 'NULL'}::{kind} AS {name}"

    parts = []
    for level in ("total", "hts", "naics", "country"):
        for time in ("yearly", "fiscal", "qtr", "monthly"):
            keys = KEYS[time] + KEYS[level]
            columns = [column(c, keys, "INTEGER") for c in ("year", "fiscal_year", "qtr", "month")]
            columns += [column(c, keys, "VARCHAR") for c in ("hts_code", "naics", "country")]
            parts.append(
                f"SELECT '{level}' AS level, '{time}' AS time_frame, {', '.join(columns)}, * EXCLUDE ({', '.join(keys)}) "
                f"FROM (WITH {rollup_ctes(level, time)} SELECT * FROM netted)")
    return " UNION ALL ".join(parts)


def unmatched_sql() -> str:
    """Keys per look-up that its table lacks."""
    keys = {
        "country_id": ("country", "l_suppkey % 27", "SELECT n_nationkey FROM nation"),
        "unit1_id": ("unit", "l_orderkey % 30", "SELECT n_nationkey FROM nation"),
        "unit2_id": ("unit", "l_linenumber", "SELECT n_nationkey FROM nation"),
        "sitc_id": ("sitc", "l_suppkey + 5", "SELECT s_suppkey FROM supplier"),
        "naics_id": ("naics", "l_linenumber", "SELECT r_regionkey FROM region"),
        "district_id": ("district", "l_linenumber - 1", "SELECT r_regionkey FROM region"),
        "hts_id": ("hts", "CASE WHEN l_orderkey % 13 <> 0 THEN l_partkey END", "SELECT p_partkey FROM part"),
    }
    return " UNION ALL ".join(
        f"SELECT '{c}' AS field, '{d}' AS dimension, ({key})::BIGINT AS key, count(*) AS records FROM lineitem "
        f"WHERE ({key}) IS NULL OR ({key}) NOT IN ({known}) GROUP BY ALL" for c, (d, key, known) in keys.items())


# The records with the key of their order.
WITH_ORDER = TRADE.replace("    date\n  FROM (", "    date, l_orderkey AS orderkey\n  FROM (")

CSV_REJECTS = f"""
WITH {WITH_ORDER},
cells AS (
  SELECT 'data' AS field, 'n/a' AS value FROM trade WHERE data % 50 = 0
  UNION ALL SELECT 'qty_1', '12.5' FROM trade WHERE data % 70 = 0
  UNION ALL SELECT 'day', 'soon' FROM trade WHERE orderkey % 90 = 0
  UNION ALL SELECT '(rows)', '' FROM trade)
SELECT field, value, count(*) AS cells FROM cells GROUP BY ALL
"""

HEADER_SPLIT = f"""
WITH {WITH_ORDER}
SELECT hts_code AS "CODE", data::VARCHAR AS "VAL", CASE WHEN (orderkey // 20000) % 2 = 1 THEN unit_1 END AS "UNIT" FROM trade
"""

LANDED_TREE = f"""
WITH {TRADE}
SELECT CASE trade_id WHEN 1 THEN 'M' ELSE 'X' END AS "flowCode", year(date)::VARCHAR AS "refYear", count(*) AS records,
       sum(data)::BIGINT AS value, sum(qty_1::FLOAT::DOUBLE) AS quantity
FROM trade WHERE trade_id IN (1, 2) GROUP BY ALL
"""

REVISED = moved("date").replace(
    "date AS date", "CASE WHEN year(date) = 2010 THEN data * 2 ELSE data END AS data")

DISTINCT_CODES = f"WITH {TRADE} SELECT DISTINCT hts_code FROM trade ORDER BY hts_code NULLS FIRST"


def oracle_sql() -> dict[str, str]:
    rollups = {
        f"{level}_{time}": rollup_sql(level, time)
        for level in ("total", "hts", "naics", "country")
        for time in ("yearly", "fiscal", "qtr", "monthly")
    }
    return rollups | {
        "stored_org_rollup": rollup_sql(
            "hts", "monthly", "starts_with(hts_code, '22') AND date BETWEEN TIMESTAMP '2009-03-01' AND TIMESTAMP '2010-10-15'",
            corrections=True),
        "stored_jp_rollup": rollup_sql("naics", "qtr", "starts_with(naics, '3') AND year(date) = 2010 AND agri_prod = 1"),
        "stored_latest": f"WITH {TRADE} SELECT date, trade_id, hts_code, country, data FROM trade WHERE date = (SELECT max(date) FROM trade)",
        "landed_tree": LANDED_TREE,
        "ingested_update": rollup_sql("hts", "yearly", records=REVISED),
        "csv_rejects": CSV_REJECTS,
        "header_split": HEADER_SPLIT,
        "star_prefix_rollup": rollup_sql("hts", "yearly", "starts_with(hts_code, '00000001')", records=STAR_TRADE),
        "star_unmatched": unmatched_sql(),
        "rollup_layouts": layouts_sql(),
        "prefix_label": PREFIX_LABEL,
        "hts_prefix_yearly": rollup_sql("hts", "yearly", "starts_with(hts_code, '22')"),
        "naics_prefix_qtr": rollup_sql("naics", "qtr", "starts_with(naics, '32')"),
        "country_prefix_fiscal": rollup_sql("country", "fiscal", "starts_with(country, 'nation_1')"),
        "agri_yearly": rollup_sql("hts", "yearly", "agri_prod = 1"),
        "range_monthly": rollup_sql(
            "total", "monthly", "date BETWEEN TIMESTAMP '2008-02-15' AND TIMESTAMP '2010-06-30'"
        ),
        "year_qtr": rollup_sql("hts", "qtr", "year(date) = 2009"),
        "corrected_hts_yearly": rollup_sql("hts", "yearly", corrections=True),
        "full_join_rollup": rollup_sql("hts", "monthly"),
        "corrections": CORRECTIONS,
        "unit_conversion": UNIT_CONVERSION,
        "date_dims": DATE_DIMS,
        "price_quarterly": price_sql(),
        "price_agri": price_sql("agri_prod = 1"),
        "price_calendar": PRICE_CALENDAR,
        "price_movers_top": movers_sql("DESC NULLS FIRST"),
        "price_movers_bottom": movers_sql("ASC NULLS FIRST"),
        "price_movers_exports": movers_sql("DESC NULLS FIRST", "exports"),
        "price_movers_drop_null": movers_sql(
            "DESC NULLS LAST", where="actual_yoy IS NOT NULL",
            records=moved("CASE WHEN hts_code < '08' THEN date + to_years((2013 - year(date))::INTEGER) ELSE date END")),
        "movers_display": "SELECT *, row_number() OVER (ORDER BY position DESC)::INTEGER AS shown_at FROM ("
        + movers_sql("DESC NULLS FIRST") + ")",
        "latest_period": LATEST_PERIOD,
        "price_statistics_monthly": price_statistics_sql(),
        "price_rolling": price_statistics_sql(
            "price_imports_mean, price_imports_std, price_imports_low, price_imports_high, "
            "price_exports_mean, price_exports_std, price_exports_low, price_exports_high"
        ),
        "price_rank": price_statistics_sql("price_imports, price_exports, rank_imports, rank_exports"),
        "price_yoy_monthly": price_statistics_sql(
            "price_imports_yoy, price_exports_yoy, rank_imports_shift, rank_exports_shift"
        ),
        "price_months": price_statistics_sql(months=True, records=moved(
            "CASE WHEN hts_code[:4]::INTEGER % 3 = 0 AND month(date) IN (3, 9) THEN date + INTERVAL 1 MONTH ELSE date END")),
        "fiscal_net": FISCAL_NET,
        "chapters": CHAPTERS,
        "distinct_codes": DISTINCT_CODES,
        "agri_flag": AGRI_FLAG,
        "naics_sector": NAICS_SECTOR,
        "star_denormalise": STAR,
        "union_directions": UNION_DIRECTIONS,
        "header_rows": HEADER_ROWS,
        "header_union": HEADER_UNION,
        "star_rollup": rollup_sql("naics", "qtr", records=STAR_TRADE),
        "org_rollup": rollup_sql("naics", "yearly"),
        "strict_prefix_yearly": rollup_sql("hts", "yearly", "starts_with(hts_code, '22')"),
    }
