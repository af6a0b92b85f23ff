"""Care pathway: cleaning, features, enriched table, result tables and dashboard queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from millrace.catalog import dirt
from millrace.catalog.quality import _canon, raw
from millrace.catalog.registry import big, half_up, query
from millrace.functions import exprs as X
from millrace.plans import care
from millrace.session import staged

ORDER = {
    "patients": [("row_id", False)],
    "diagnoses": [("row_id", False)],
    "admissions": [(c, False) for c in ("ship_date", "part_id", "supplier_id", "price")],
}


def _raw(spark, sf, name):
    return dirt.frame(spark, sf, getattr(dirt, f"RAW_{name.upper()}"))


def _admissions(spark, sf):
    return care.clean_admissions(_raw(spark, sf, "admissions"), ORDER["admissions"])


def _silver(spark, sf, columns=care.SILVER_COLUMNS):
    """The enriched table, or the columns of it a result reads."""
    return care.enrich(
        _raw(spark, sf, "patients"), _raw(spark, sf, "diagnoses"), _raw(spark, sf, "admissions"), ORDER, columns
    )


_ADM_COLS = "admission_id, patient_id, diagnosis_id, department, physician, admission_date, discharge_date, length_of_stay, readmitted_within_30_days"

_CLEAN = f"""{raw('patients', 'diagnoses', 'admissions')},
    people AS (SELECT patient_id, coalesce(name, 'Unknown') AS name, age, gender, coalesce(contact, 'Unknown') AS contact
        FROM raw_patients QUALIFY row_number() OVER (PARTITION BY patient_id ORDER BY row_id) = 1),
    codes AS (SELECT diagnosis_id, icd_code, category FROM raw_diagnoses
        QUALIFY row_number() OVER (PARTITION BY diagnosis_id ORDER BY row_id) = 1),
    adm AS (SELECT admission_id, patient_id, diagnosis_id, {_canon('department')} AS department,
        coalesce(physician, 'Unassigned') AS physician, admission_date, discharge_date, length_of_stay,
        readmitted_within_30_days FROM raw_admissions QUALIFY row_number() OVER (PARTITION BY admission_id
        ORDER BY ship_date, part_id, supplier_id, price) = 1)"""

_AGE = "CASE WHEN age <= 18 THEN '0-18' WHEN age <= 35 THEN '19-35' WHEN age <= 60 THEN '36-60' ELSE '60+' END"
_BUCKET = "CASE WHEN length_of_stay <= 2 THEN 'Short' WHEN length_of_stay <= 7 THEN 'Medium' ELSE 'Long' END"

_SILVER = f"""{_CLEAN},
    valid AS (SELECT admission_id, patient_id, diagnosis_id, department, physician, admission_date, discharge_date,
        CAST(discharge_date - admission_date AS INTEGER) AS length_of_stay,
        CASE WHEN readmitted_within_30_days = 1 THEN 1 ELSE 0 END AS readmission_flag FROM adm
        WHERE patient_id IN (SELECT patient_id FROM people) AND diagnosis_id IN (SELECT diagnosis_id FROM codes)),
    comorb AS (SELECT patient_id, count(DISTINCT diagnosis_id) AS comorbidity_index FROM valid GROUP BY patient_id),
    silver AS (SELECT v.*, p.name, p.age, p.gender, p.contact, c.icd_code, c.category, {_AGE} AS age_group,
        strftime(admission_date, '%Y-%m') AS admission_month, {_BUCKET} AS los_bucket, m.comorbidity_index,
        row_number() OVER (PARTITION BY v.patient_id ORDER BY admission_date, admission_id) - 1 AS prior_admission_count
        FROM valid v JOIN people p ON p.patient_id = v.patient_id JOIN codes c ON c.diagnosis_id = v.diagnosis_id
        JOIN comorb m ON m.patient_id = v.patient_id)"""

_STATS = f"""count(*) AS total_admissions, {half_up('avg(readmission_flag)', 4)} AS readmission_rate,
    {half_up('avg(length_of_stay)', 2)} AS avg_los"""

_GOLD = f"""{_SILVER},
    dia0 AS (SELECT category AS diagnosis_category, {_STATS}, {big('sum(readmission_flag)')} AS total_readmissions
        FROM silver GROUP BY category),
    dia AS (SELECT *, dense_rank() OVER (ORDER BY readmission_rate DESC) AS readmission_rank FROM dia0),
    dep0 AS (SELECT department, {_STATS} FROM silver GROUP BY department),
    dep1 AS (SELECT *, {half_up('readmission_rate * 100 + avg_los * 2', 2)} AS performance_score FROM dep0),
    dep AS (SELECT *, dense_rank() OVER (ORDER BY performance_score DESC) AS performance_rank FROM dep1),
    ages AS (SELECT age_group, count(DISTINCT patient_id) AS patient_count, {_STATS} FROM silver GROUP BY age_group),
    risk0 AS (SELECT patient_id, name, age, age_group, count(*) AS total_admissions,
        {big('sum(readmission_flag)')} AS total_readmissions, {half_up('avg(length_of_stay)', 2)} AS avg_los,
        max(comorbidity_index) AS comorbidity_index FROM silver GROUP BY patient_id, name, age, age_group),
    risk AS (SELECT *, CASE WHEN total_readmissions >= 3 THEN 'High' WHEN total_readmissions >= 1 THEN 'Medium'
        ELSE 'Low' END AS risk_category, dense_rank() OVER (ORDER BY total_readmissions DESC) AS risk_rank FROM risk0)"""


# --- cleaning -----------------------------------------------------------------


@query("clean_patients", f"WITH {_CLEAN} SELECT * FROM people")
def clean_patients(spark, sf):
    return care.clean_patients(_raw(spark, sf, "patients"), ORDER["patients"]).drop("row_id")


@query("clean_diagnoses", f"WITH {_CLEAN} SELECT * FROM codes")
def clean_diagnoses(spark, sf):
    return care.clean_diagnoses(_raw(spark, sf, "diagnoses"), ORDER["diagnoses"]).drop("row_id")


@query("clean_admissions", f"WITH {_CLEAN} SELECT {_ADM_COLS} FROM adm")
def clean_admissions(spark, sf):
    return _admissions(spark, sf).select(*_ADM_COLS.split(", "))


# --- features -------------------------------------------------------------------


@query(
    "feat_los",
    f"""WITH {raw('admissions')} SELECT admission_id, part_id, supplier_id, ship_date,
        CAST(discharge_date - admission_date AS INTEGER) AS length_of_stay FROM raw_admissions""",
)
def feat_los(spark, sf):
    return care.with_stay(_raw(spark, sf, "admissions")).select(
        "admission_id", "part_id", "supplier_id", "ship_date", "length_of_stay"
    )


@query(
    "feat_flag",
    f"""WITH {raw('admissions')} SELECT admission_id, part_id, supplier_id, ship_date,
        CASE WHEN readmitted_within_30_days = 1 THEN 1 ELSE 0 END AS readmission_flag FROM raw_admissions""",
)
def feat_flag(spark, sf):
    return care.with_flag(_raw(spark, sf, "admissions")).select(
        "admission_id", "part_id", "supplier_id", "ship_date", "readmission_flag"
    )


@query("feat_age_group", f"WITH {_CLEAN} SELECT patient_id, age, {_AGE} AS age_group FROM people")
def feat_age_group(spark, sf):
    people = care.clean_patients(_raw(spark, sf, "patients"), ORDER["patients"])
    return people.select("patient_id", "age", care.age_group("age").alias("age_group"))


@query(
    "feat_month",
    f"""WITH {raw('admissions')} SELECT strftime(admission_date, '%Y-%m') AS admission_month, count(*) AS rows_in_month
        FROM raw_admissions GROUP BY 1""",
)
def feat_month(spark, sf):
    return _raw(spark, sf, "admissions").groupBy(
        X.year_month("admission_date").alias("admission_month")
    ).agg(F.count(F.lit(1)).alias("rows_in_month"))


@query(
    "feat_los_bucket",
    f"""WITH {raw('admissions')}, s AS (SELECT CAST(discharge_date - admission_date AS INTEGER) AS length_of_stay
        FROM raw_admissions) SELECT {_BUCKET} AS los_bucket, count(*) AS admissions FROM s GROUP BY 1""",
)
def feat_los_bucket(spark, sf):
    stays = care.with_stay(_raw(spark, sf, "admissions"))
    return stays.groupBy(care.stay_bucket("length_of_stay").alias("los_bucket")).agg(
        F.count(F.lit(1)).alias("admissions")
    )


@query(
    "feat_comorbidity",
    f"""WITH {_CLEAN}, n AS (SELECT patient_id, count(DISTINCT diagnosis_id) AS comorbidity_index FROM adm GROUP BY 1)
        SELECT a.admission_id, a.patient_id, n.comorbidity_index FROM adm a JOIN n ON n.patient_id = a.patient_id""",
)
def feat_comorbidity(spark, sf):
    keys = _admissions(spark, sf).select("admission_id", "patient_id", "diagnosis_id")
    return care.with_comorbidity(staged(keys)).drop("diagnosis_id")


@query(
    "feat_prior_count",
    f"""WITH {_CLEAN} SELECT admission_id, patient_id, row_number() OVER (PARTITION BY patient_id
        ORDER BY admission_date, admission_id) - 1 AS prior_admission_count FROM adm""",
)
def feat_prior_count(spark, sf):
    keys = _admissions(spark, sf).select("admission_id", "patient_id", "admission_date")
    return care.with_prior_count(staged(keys)).drop("admission_date")


# --- tables -------------------------------------------------------------------------


@query("silver_enriched", f"WITH {_SILVER} SELECT {', '.join(care.SILVER_COLUMNS)} FROM silver")
def silver_enriched(spark, sf):
    return _silver(spark, sf)


@query("gold_by_diagnosis", f"WITH {_GOLD} SELECT * FROM dia")
def gold_by_diagnosis(spark, sf):
    return care.by_diagnosis(_silver(spark, sf, care.BY_DIAGNOSIS))


@query("gold_department", f"WITH {_GOLD} SELECT * FROM dep")
def gold_department(spark, sf):
    return care.by_department(_silver(spark, sf, care.BY_DEPARTMENT))


@query("gold_age_group", f"WITH {_GOLD} SELECT * FROM ages")
def gold_age_group(spark, sf):
    return care.by_age_group(_silver(spark, sf, care.BY_AGE_GROUP))


@query("gold_patient_risk", f"WITH {_GOLD} SELECT * FROM risk")
def gold_patient_risk(spark, sf):
    return care.patient_risk(staged(_silver(spark, sf, care.PROFILE), "silver"))


@query(
    "gold_summary",
    f"""WITH {_GOLD} SELECT 'risk_distribution' AS section, risk_category AS item, CAST(count(*) AS DOUBLE) AS value
        FROM risk GROUP BY 2
        UNION ALL (SELECT 'worst_departments', department, performance_score FROM dep
            ORDER BY performance_score DESC, department LIMIT 3)
        UNION ALL (SELECT 'worst_diagnosis', diagnosis_category, readmission_rate FROM dia
            ORDER BY readmission_rate DESC, diagnosis_category LIMIT 1)""",
)
def gold_summary(spark, sf):
    columns = dict.fromkeys([*care.BY_PATIENT, *care.BY_DEPARTMENT, *care.BY_DIAGNOSIS])
    return care.summary(staged(_silver(spark, sf, list(columns)), "silver"))


@query(
    "bronze_check",
    f"""WITH {raw('patients', 'admissions')}, p AS (SELECT DISTINCT patient_id, age FROM raw_patients)
        SELECT CASE WHEN age >= 65 THEN 'elderly' ELSE 'non_elderly' END AS age_group,
        {half_up('avg(readmitted_within_30_days)', 4)} AS readmission_rate FROM raw_admissions a
        JOIN p ON p.patient_id = a.patient_id GROUP BY 1""",
)
def bronze_check(spark, sf):
    people = _raw(spark, sf, "patients").select("patient_id", "age").distinct()
    return care.elderly_rates(_raw(spark, sf, "admissions"), people)


# --- dashboard ------------------------------------------------------------------------


@query(
    "sql_diagnosis",
    f"""WITH {_GOLD} SELECT diagnosis_category, total_admissions, total_readmissions, readmission_rate, avg_los,
        readmission_rank FROM dia""",
)
def sql_diagnosis(spark, sf):
    table = care.by_diagnosis(_silver(spark, sf, care.BY_DIAGNOSIS))
    return spark.sql("SELECT * FROM {t} ORDER BY readmission_rate DESC", t=table)


@query("sql_department", f"WITH {_GOLD} SELECT * FROM dep")
def sql_department(spark, sf):
    table = care.by_department(_silver(spark, sf, care.BY_DEPARTMENT))
    return spark.sql("SELECT * FROM {t} ORDER BY performance_score DESC", t=table)


@query("sql_age", f"WITH {_GOLD} SELECT * FROM ages")
def sql_age(spark, sf):
    table = care.by_age_group(_silver(spark, sf, care.BY_AGE_GROUP))
    return spark.sql("SELECT * FROM {t} ORDER BY readmission_rate DESC", t=table)


@query("sql_intervention", f"WITH {_GOLD} SELECT * EXCLUDE (risk_rank) FROM risk WHERE risk_category = 'High'")
def sql_intervention(spark, sf):
    return care.intervention_list(care.risk_profile(_silver(spark, sf, care.PROFILE)))


@query("sql_los_trend", f"WITH {_SILVER} SELECT admission_month, {_STATS} FROM silver GROUP BY 1")
def sql_los_trend(spark, sf):
    return care.stay_trend(_silver(spark, sf, care.BY_MONTH))


@query(
    "sql_crosstab",
    f"WITH {_SILVER} SELECT department, category AS diagnosis_category, {_STATS} FROM silver GROUP BY 1, 2",
)
def sql_crosstab(spark, sf):
    return care.department_diagnosis(_silver(spark, sf, care.BY_BOTH))


@query(
    "sql_highrisk_dept",
    f"""WITH {_GOLD} SELECT s.department, count(DISTINCT r.patient_id) AS high_risk_patient_count FROM risk r
        JOIN silver s ON s.patient_id = r.patient_id WHERE r.risk_category = 'High' GROUP BY 1""",
)
def sql_highrisk_dept(spark, sf):
    silver = staged(_silver(spark, sf, [*care.BY_PATIENT, "department"]), "silver")
    return care.high_risk_by_department(silver, care.risk_levels(silver))


@query(
    "join_gold_silver",
    f"""WITH {_GOLD} SELECT s.category, count(DISTINCT s.patient_id) AS patients, count(*) AS admissions FROM risk r
        JOIN silver s ON s.patient_id = r.patient_id WHERE r.risk_category <> 'Low' GROUP BY 1""",
)
def join_gold_silver(spark, sf):
    """Admissions are counted per patient and category before they meet the profile."""
    silver = staged(_silver(spark, sf, [*care.BY_PATIENT, "category"]), "silver")
    pairs = silver.groupBy("patient_id", "category").agg(F.count(F.lit(1)).alias("n"))
    risky = care.risk_levels(silver).where("risk_category <> 'Low'").select("patient_id")
    return (
        pairs.join(risky, "patient_id")
        .groupBy("category")
        .agg(F.count(F.lit(1)).alias("patients"), F.sum("n").alias("admissions"))
    )


@query(
    "sql_header",
    f"""WITH {_GOLD} SELECT (SELECT count(DISTINCT patient_id) FROM silver) AS total_patients,
        (SELECT count(*) FROM silver) AS total_admissions,
        (SELECT {half_up('avg(readmission_flag)', 4)} FROM silver) AS overall_readmission_rate,
        (SELECT {half_up('avg(length_of_stay)', 2)} FROM silver) AS overall_avg_los,
        (SELECT count(*) FROM risk WHERE risk_category = 'High') AS high_risk_patients""",
)
def sql_header(spark, sf):
    return care.header(_silver(spark, sf, care.BY_PATIENT))
