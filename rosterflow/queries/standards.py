"""The five standards tables over workbooks made of customers and suppliers.

Each nation is one workbook of its region's year. Customers are the rows of the
provider sheets, suppliers those of the facility and certificate-of-need sheets.
European workbooks have no provider counts, Asian ones no customised flag.
"""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rosterflow import schemas as S
from rosterflow.operators.reshape import sheet_layout
from rosterflow.plans import standards
from rosterflow.queries.registry import Tables, query
from rosterflow.queries.reshape import sheet_frame
from rosterflow.session import fresh_path, materialise
from rosterflow.sinks.tables import target, write_tables

_WORKBOOKS = """
books AS (SELECT n_nationkey, 'wb' || CAST(n_nationkey AS VARCHAR) AS path, 2020 + n_regionkey AS contract_year, r_name
          FROM nation JOIN region ON n_regionkey = r_regionkey),
customers AS (SELECT b.*, c.*, CAST(c_custkey // 100 AS VARCHAR) AS ssacd FROM customer c JOIN books b ON c_nationkey = n_nationkey),
suppliers AS (SELECT b.*, s.*, CAST(s_suppkey // 10 AS VARCHAR) AS ssacd FROM supplier s JOIN books b ON s_nationkey = n_nationkey),
provider_counts AS (
    SELECT path, ssacd, contract_year, c_custkey, c_nationkey, u.code AS specialty_code,
           CASE u.code WHEN '001' THEN CASE WHEN c_custkey % 3 > 0 THEN c_custkey END
                       WHEN '002' THEN CAST(c_nationkey AS BIGINT) ELSE c_custkey % 9 END AS min_count
    FROM customers, (VALUES ('001'), ('002'), ('040')) u(code) WHERE r_name <> 'EUROPE'),
facility_counts AS (
    SELECT path, ssacd, contract_year, s_suppkey, s_nationkey, u.code AS specialty_code,
           CASE u.code WHEN '040' THEN s_suppkey ELSE s_suppkey * 2 END AS min_count
    FROM suppliers, (VALUES ('040'), ('041')) u(code)),
provider_td AS (
    SELECT path, ssacd, contract_year, c_custkey, '001' AS specialty_code,
           CASE WHEN c_custkey % 4 > 0 THEN c_custkey % 60 END AS minutes, CASE WHEN c_custkey % 3 > 0 THEN c_custkey % 45 END AS miles
    FROM customers
    UNION ALL
    SELECT path, ssacd, contract_year, c_custkey, '002', CAST(c_nationkey AS BIGINT), NULL FROM customers),
facility_td AS (SELECT path, ssacd, contract_year, '040' AS specialty_code, s_suppkey AS minutes, CAST(s_nationkey AS BIGINT) AS miles
                FROM suppliers),
con AS (SELECT path, r_name, ssacd, contract_year, CASE WHEN s_suppkey % 2 = 0 THEN '001' ELSE '040' END AS specialty_code,
               CASE s_suppkey % 3 WHEN 0 THEN 'y' WHEN 1 THEN 'N' END AS flag FROM suppliers)
"""


def workbooks(t: Tables, *sheets: str) -> tuple[DataFrame, DataFrame]:
    """Rows and layouts of the named sheets of all workbooks, staged as the standards job does."""
    rows = materialise(_sheets(t).filter(F.col("sheet").isin(*sheets)), "sheet-rows", ("sheet",))
    return rows, materialise(sheet_layout(rows), "sheet-layouts")


def _sheets(t: Tables) -> DataFrame:
    books = F.broadcast(  # one row per nation
        t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
            "n_nationkey",
            F.concat(F.lit("wb"), F.col("n_nationkey").cast("string")).alias("path"),
            (F.lit(2020) + F.col("n_regionkey")).alias("source_year"),
            "r_name",
        )
    )
    paths = books.select("path", "source_year", "r_name")
    key, none = F.col("c_custkey"), F.lit(None)
    customers = t.customer.join(books, F.col("c_nationkey") == F.col("n_nationkey"))
    suppliers = t.supplier.join(books, F.col("s_nationkey") == F.col("n_nationkey"))
    ssacd = F.floor(key / 100).cast("string")
    supplier_key = F.col("s_suppkey")
    supplier_ssacd = F.floor(supplier_key / 10).cast("string")

    def ids(name, designation, code):
        return [F.col(name), F.col("r_name"), none, code, designation]

    provider_counts = customers.filter("r_name <> 'EUROPE'").select(
        "path",
        "source_year",
        (key + 3).alias("row_idx"),
        F.array(
            F.col("c_name"),
            F.col("r_name"),
            none,
            ssacd,
            F.when(key % 4 > 0, (key * 10).cast("string")).otherwise("n/a"),
            F.concat(F.lit(" Large  "), "c_mktsegment", F.lit(" #1")),
            F.concat(F.lit("0."), F.col("c_nationkey").cast("string")),
            none,
            F.when(key % 3 > 0, key.cast("string")),
            F.col("c_nationkey").cast("string"),
            (key % 9).cast("string"),
        ).alias("cells"),
    )
    facility_counts = suppliers.select(
        "path",
        "source_year",
        (supplier_key + 3).alias("row_idx"),
        F.array(
            *[F.col("s_name"), F.col("r_name"), none, supplier_ssacd, none, none],
            F.concat(F.lit("1."), F.col("s_nationkey").cast("string")),
            none,
            supplier_key.cast("string"),
            (supplier_key * 2).cast("string"),
        ).alias("cells"),
    )
    provider_td = customers.select(
        "path",
        "source_year",
        (key + 4).alias("row_idx"),
        F.array(
            *ids("c_name", F.col("c_mktsegment"), ssacd),
            F.when(key % 4 > 0, F.concat((key % 60).cast("string"), F.lit(".5"))).otherwise("n/a"),
            F.when(key % 3 > 0, (key % 45).cast("string")),
            F.col("c_nationkey").cast("string"),
            none,
        ).alias("cells"),
    )
    facility_td = suppliers.select(
        "path",
        "source_year",
        (supplier_key + 4).alias("row_idx"),
        F.array(
            *ids("s_name", none, supplier_ssacd), supplier_key.cast("string"), F.col("s_nationkey").cast("string")
        ).alias("cells"),
    )
    specialty = F.when(supplier_key % 2 == 0, "001").otherwise("040")
    flag = F.when(supplier_key % 3 == 0, "y").when(supplier_key % 3 == 1, "N")
    con = suppliers.select("r_name", "path", "source_year", (supplier_key + 1).alias("row_idx"), F.array(supplier_ssacd, specialty, flag).alias("cells"))
    asian = suppliers.select("r_name", "path", "source_year", (supplier_key + 1).alias("row_idx"), F.array(F.col("r_name"), supplier_ssacd, specialty).alias("cells"))

    count_heads = [["title"], ["COUNTY"], [None] * 8]
    pair_heads = [["title"], ["COUNTY"], [None] * 5, [None] * 5 + ["Time", "Distance"]]
    in_asia = F.col("r_name") == "ASIA"
    return reduce(
        DataFrame.unionByName,
        [
            sheet_frame(
                paths.filter("r_name <> 'EUROPE'"),
                S.SHEET_MIN_PROVIDER,
                [*count_heads[:2], count_heads[2] + ["001", " 002", "040"]],
                provider_counts,
            ),
            sheet_frame(paths, S.SHEET_MIN_FACILITY, [*count_heads[:2], count_heads[2] + ["040", "041"]], facility_counts),
            sheet_frame(
                paths, S.SHEET_TD_PROVIDER, [*pair_heads[:2], pair_heads[2] + ["001", None, "002"], pair_heads[3]], provider_td
            ),
            sheet_frame(paths, S.SHEET_TD_FACILITY, [*pair_heads[:2], pair_heads[2] + ["040"], pair_heads[3]], facility_td),
            sheet_frame(paths.filter(~in_asia), S.SHEET_CON, [["SSA", "Specialty  Code", "TD Customized (YN)"]], con.filter(~in_asia)),
            sheet_frame(paths.filter(in_asia), S.SHEET_CON, [["State", "County SSA #", "Specialty Code"]], asian.filter(in_asia)),
        ],
    )


@query(f"""
WITH {_WORKBOOKS},
base AS (
    SELECT path, ssacd, contract_year, c_custkey AS k, c_name, r_name, 'large_' || lower(c_mktsegment) || '_1' AS county_type,
           CASE WHEN c_custkey % 4 > 0 THEN c_custkey * 10 END AS total FROM customers WHERE r_name <> 'EUROPE'
    UNION ALL
    SELECT path, ssacd, contract_year, c_custkey, c_name, r_name, lower(c_mktsegment), NULL FROM customers WHERE r_name = 'EUROPE')
SELECT ssacd AS ssa_county_code, contract_year, c_name AS county_name, r_name AS state_code, county_type,
       total AS total_medicare_beneficiaries, CAST(NULL AS BOOLEAN) AS con_state
FROM base QUALIFY row_number() OVER (PARTITION BY path, ssacd ORDER BY k) = 1
""")
def county_table(t):
    rows, layout = workbooks(t, S.SHEET_MIN_PROVIDER, S.SHEET_TD_PROVIDER)
    return standards.county_table(rows, layout)


@query(f"""
WITH {_WORKBOOKS}
SELECT specialty_code, contract_year, CAST(NULL AS VARCHAR) AS specialty_name, category, CAST(NULL AS BOOLEAN) AS telehealth_eligible
FROM (SELECT specialty_code, contract_year, 'provider' AS category FROM provider_counts
      UNION SELECT specialty_code, contract_year, 'facility' FROM facility_counts)
""")
def specialty_table(t):
    rows, layout = workbooks(t, S.SHEET_MIN_PROVIDER, S.SHEET_MIN_FACILITY)
    return standards.specialty_table(
        standards.min_counts(rows, "provider", layout), standards.min_counts(rows, "facility", layout)
    )


@query(f"""
WITH {_WORKBOOKS},
td AS (SELECT path, ssacd, contract_year, specialty_code, minutes, miles FROM provider_td WHERE minutes IS NOT NULL OR miles IS NOT NULL
       UNION ALL SELECT path, ssacd, contract_year, specialty_code, minutes, miles FROM facility_td),
lookup AS (SELECT DISTINCT path, ssacd, specialty_code, upper(flag) = 'Y' AS is_customized FROM con WHERE r_name <> 'ASIA')
SELECT ssacd AS ssa_county_code, specialty_code, contract_year, minutes AS max_time_minutes, miles AS max_distance_miles,
       90 AS pct_beneficiaries_required, is_customized
FROM td LEFT JOIN lookup USING (path, ssacd, specialty_code)
""")
def td_standard_table(t):
    rows, layout = workbooks(t, S.SHEET_TD_PROVIDER, S.SHEET_TD_FACILITY, S.SHEET_CON)
    return standards.time_distance_table(
        standards.time_distances(rows, "provider", layout),
        standards.time_distances(rows, "facility", layout),
        standards.con_rows(rows, layout),
    )


@query(f"""
WITH {_WORKBOOKS},
p AS (SELECT path, ssacd, specialty_code, contract_year, min_count, ('0.' || c_nationkey)::DOUBLE AS ratio FROM provider_counts),
f AS (SELECT path, ssacd, specialty_code, contract_year, CASE WHEN specialty_code = '040' THEN min_count END AS beds,
             ('1.' || s_nationkey)::DOUBLE AS ratio FROM facility_counts)
SELECT ssacd AS ssa_county_code, specialty_code, contract_year, p.min_count AS min_providers_required, f.beds AS min_beds_required,
       CAST(NULL AS DOUBLE) AS provider_ratio, coalesce(p.ratio, f.ratio) AS base_population_ratio_95th_pct
FROM p FULL JOIN f USING (path, ssacd, specialty_code, contract_year)
""")
def min_standard_table(t):
    rows, layout = workbooks(t, S.SHEET_MIN_PROVIDER, S.SHEET_MIN_FACILITY)
    return standards.minimum_number_table(
        standards.min_counts(rows, "provider", layout), standards.min_counts(rows, "facility", layout)
    )


@query(f"""
WITH {_WORKBOOKS}
SELECT DISTINCT ssacd AS ssa_county_code, specialty_code, contract_year FROM con
""")
def con_credit_table(t):
    rows, layout = workbooks(t, S.SHEET_CON)
    return standards.con_credit_table(standards.con_rows(rows, layout))


@query(f"""
WITH {_WORKBOOKS}
SELECT DISTINCT 'con_credit' AS written, ssacd AS code, contract_year FROM con
UNION ALL SELECT DISTINCT 'specialty_type', category || specialty_code, contract_year FROM (
  SELECT specialty_code, contract_year, 'provider' AS category FROM provider_counts UNION ALL SELECT specialty_code, contract_year, 'facility' FROM facility_counts)
""")
def standards_job(t):
    """All tables of the job, written in order to a folder; the codes of two of them read back."""
    rows = materialise(_sheets(t), "sheet-rows", ("sheet",))
    folder = fresh_path(t.spark, "standards")
    write_tables(standards.standards_tables(rows), S.REFERENCE_TABLES, folder)

    def stored(name: str) -> DataFrame:
        return t.spark.read.parquet(target(folder, name))

    credits = stored("con_credit").select(F.lit("con_credit").alias("written"), F.col("ssa_county_code").alias("code"), "contract_year").distinct()
    specialties = stored("specialty_type").select(F.lit("specialty_type").alias("written"), F.concat("category", "specialty_code").alias("code"), "contract_year")
    return credits.unionByName(specialties)
