"""DuckDB SQL for the registered queries, on the same driver tables."""
from __future__ import annotations

import re

from scorelake.demo.binding import AS_OF, PROFILED_UPLOADS, TABLE_COLUMNS, TABLES, UPLOAD_BOOKS, UPLOAD_NAMES, duckdb_ctes, uploaded_columns
from scorelake.plans.schemas import BONUS, COLUMNS, FIELD_WORDS, IGNORED_TABLE_WORDS, REQUIRED, TABLE_WORDS

CTES = duckdb_ctes()
ORACLES: dict[str, str] = {}
TODAY = f"CAST('{AS_OF}' AS DATE)"
ISO = r"'^\d{4}-(0[1-9]|1[0-2])-(0[1-9]|[12]\d|3[01])$'"
NUM = r"'^-?\d+([.,]\d+)?$'"
FORMATS = "['%Y-%m-%d %H:%M:%S', '%Y-%m-%d', '%d/%m/%Y %H:%M:%S', '%d/%m/%Y', '%Y/%m/%d %H:%M:%S', '%Y/%m/%d', '%d-%m-%Y %H:%M:%S', '%d-%m-%Y']"


def avg2(x: str) -> str:
    return f"CAST(round(CAST(CAST(sum({x}) AS DECIMAL(18,2)) / count({x}) AS DECIMAL(18,8)), 2) AS DECIMAL(5,2))"


def rate2(part: str, whole: str) -> str:
    return f"CAST(round(CAST(({part}) * 100.0 / nullif({whole}, 0) AS DECIMAL(18,8)), 2) AS DECIMAL(5,2))"


def count_where(c: str) -> str:
    return f"CAST(sum(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT)"


def dec_text(c: str) -> str:
    """Decimal text by shape, comma or dot, as DECIMAL(5,2)."""
    return f"CASE WHEN regexp_matches({c}, {NUM}) THEN TRY_CAST(replace(trim({c}), ',', '.') AS DECIMAL(5,2)) END"


def iso_date(c: str) -> str:
    return f"CASE WHEN regexp_matches({c}, {ISO}) THEN TRY_CAST({c} AS DATE) END"


def whole(c: str) -> str:
    return rf"CASE WHEN regexp_matches(trim({c}), '^\d+$') THEN TRY_CAST(trim({c}) AS INTEGER) END"


def json_kept(c: str) -> str:
    return f"CASE WHEN json_valid(nullif(trim({c}), '')) THEN nullif(trim({c}), '') END"


def gender(c: str, fem: str = "") -> str:
    return (
        f"CASE WHEN lower(trim({c})) IN ('m', 'masculino', 'male', 'hombre') THEN 'M' "
        f"WHEN lower(trim({c})) IN ('f', 'femenino', 'female', {fem}'mujer') THEN 'F' ELSE nullif(trim({c}), '') END"
    )


def header(c: str) -> str:
    stripped = rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"
    ascii_only = rf"regexp_replace(strip_accents(lower({stripped})), '[^\x00-\x7F]', '', 'g')"
    return rf"trim(regexp_replace(regexp_replace({ascii_only}, '[^\w\s]', ' ', 'g'), '\s+', '_', 'g'), '_')"


def firsts(source: str, key: str, order: str, where: str, cells: dict[str, str]) -> str:
    body = ", ".join(f"{sql} AS {name}" for name, sql in cells.items())
    names = ", ".join(cells)
    return (
        f"SELECT {names} FROM (SELECT {body}, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn "
        f"FROM {source} r WHERE {where}) WHERE rn = 1"
    )


# Star schema and marts
CTES["fact"] = """
SELECT g.grade_id, g.student_id, e.subject_id, coalesce(e.course_id, s.course_id) AS course_id, e.period_id, g.submission_date,
  e.assessment_id, e.assessment_name, e.assessment_type, e.weight_percentage, g.score,
  CAST(round(g.score * e.weight_percentage * CAST(0.01 AS DECIMAL(3,2)), 3) AS DECIMAL(6,3)) AS weighted_points,
  g.score >= 3.0 AS is_passing, g.feedback
FROM c_grades g JOIN c_assessments e ON g.assessment_id = e.assessment_id JOIN c_students s ON g.student_id = s.student_id"""
CTES["final"] = """
SELECT *, final_grade >= 3.0 AS is_approved, CASE WHEN final_grade >= 3.0 THEN 'APROBADO' ELSE 'REPROBADO' END AS approval_status FROM (
SELECT f.student_id, s.first_name || ' ' || s.last_name AS full_name, f.course_id, coalesce(c.course_name, 'Sin Curso') AS course_name,
  f.subject_id, coalesce(b.subject_name, 'Sin Materia') AS subject_name, coalesce(b.department, 'General') AS department, f.period_id,
  CAST(round(sum(f.weighted_points), 2) AS DECIMAL(5,2)) AS final_grade, count(f.grade_id) AS total_assessments,
  CAST(round(sum(f.weight_percentage), 2) AS DECIMAL(9,2)) AS total_weight_evaluated, bool_and(f.is_passing) AS passed_all_assessments
FROM fact f JOIN c_students s ON f.student_id = s.student_id LEFT JOIN c_courses c ON f.course_id = c.course_id
LEFT JOIN c_subjects b ON f.subject_id = b.subject_id GROUP BY ALL)"""
CTES["subject_perf"] = f"""
SELECT subject_id, subject_name, course_id, course_name, department, count(DISTINCT student_id) AS enrolled_students,
  {avg2('final_grade')} AS average_final_grade, min(final_grade) AS min_final_grade, max(final_grade) AS max_final_grade,
  {count_where('is_approved')} AS approved_count, {count_where('NOT is_approved')} AS failed_count,
  {rate2(count_where('is_approved'), 'count(final_grade)')} AS pass_rate_percentage,
  {rate2(count_where('NOT is_approved'), 'count(final_grade)')} AS fail_rate_percentage
FROM final GROUP BY subject_id, subject_name, course_id, course_name, department"""
CTES["student_perf"] = f"""
SELECT *, CAST(dense_rank() OVER (ORDER BY overall_average DESC NULLS FIRST) AS INTEGER) AS academic_ranking_overall,
  CAST(dense_rank() OVER (PARTITION BY course_id ORDER BY overall_average DESC NULLS FIRST) AS INTEGER) AS academic_ranking_in_course,
  CASE WHEN overall_average >= 4.5 THEN 'Excelente (Cuadro de Honor)' WHEN overall_average >= 4.0 THEN 'Sobresaliente'
    WHEN overall_average >= 3.0 THEN 'Aceptable' ELSE 'Bajo / En Riesgo Académico' END AS performance_category
FROM (SELECT student_id, full_name, course_id, course_name, count(DISTINCT subject_id) AS subjects_enrolled,
  {count_where('is_approved')} AS subjects_passed, {count_where('NOT is_approved')} AS subjects_failed,
  {avg2('final_grade')} AS overall_average, min(final_grade) AS lowest_subject_grade, max(final_grade) AS highest_subject_grade
  FROM final GROUP BY student_id, full_name, course_id, course_name)"""
CTES["course_perf"] = f"""
SELECT c.course_id, c.course_name, c.grade_level, c.academic_year, count(DISTINCT p.student_id) AS total_students,
  {avg2('p.overall_average')} AS course_gpa, CAST(sum(p.subjects_passed) AS BIGINT) AS total_subjects_passed,
  CAST(sum(p.subjects_failed) AS BIGINT) AS total_subjects_failed,
  {rate2('sum(p.subjects_passed)', 'sum(p.subjects_passed + p.subjects_failed)')} AS overall_pass_rate_percentage,
  {rate2('sum(p.subjects_failed)', 'sum(p.subjects_passed + p.subjects_failed)')} AS overall_fail_rate_percentage
FROM c_courses c JOIN student_perf p ON c.course_id = p.course_id GROUP BY 1, 2, 3, 4"""
CTES["cohorts"] = """
SELECT 'Top 5 Cuadro de Honor' AS cohort_group, academic_ranking_overall AS ranking_position, student_id, full_name, course_name, overall_average
FROM (SELECT *, row_number() OVER (ORDER BY overall_average DESC NULLS FIRST, student_id, course_id) AS rn FROM student_perf) WHERE rn <= 5
UNION ALL SELECT 'Bottom 5 Plan de Refuerzo', academic_ranking_overall, student_id, full_name, course_name, overall_average
FROM (SELECT *, row_number() OVER (ORDER BY overall_average ASC NULLS LAST, student_id, course_id) AS rn FROM student_perf) WHERE rn <= 5"""
CTES["failures"] = """
SELECT subject_id, subject_name, course_name, department, enrolled_students, failed_count, fail_rate_percentage, average_final_grade,
  CAST(dense_rank() OVER (ORDER BY fail_rate_percentage DESC NULLS FIRST, average_final_grade ASC NULLS LAST) AS INTEGER) AS failure_rank
FROM subject_perf"""
ORACLES["fact_grades"] = "SELECT * FROM fact"
ORACLES["final_grade"] = "SELECT * FROM final"
ORACLES["subject_performance"] = "SELECT * FROM subject_perf"
ORACLES["student_performance"] = "SELECT * FROM student_perf"
ORACLES["course_performance"] = "SELECT * FROM course_perf"
ORACLES["assessment_type_performance"] = f"""
SELECT coalesce(assessment_type, 'General') AS assessment_type, count(*) AS total_evaluations_taken, {avg2('score')} AS average_score,
  min(score) AS min_score, max(score) AS max_score, {count_where('is_passing')} AS passing_count, {count_where('NOT is_passing')} AS failing_count,
  {rate2(count_where('is_passing'), 'count(*)')} AS pass_rate_percentage FROM fact f GROUP BY f.assessment_type"""
ORACLES["top_bottom"] = "SELECT * FROM cohorts"
ORACLES["highest_failure"] = "SELECT * FROM failures"
ORACLES["dim_course"] = "SELECT course_id, course_name, grade_level, academic_year FROM st_courses"
ORACLES["dim_subject"] = "SELECT subject_id, subject_name, course_id, department FROM c_subjects"
ORACLES["dim_period"] = "SELECT * FROM c_periods"
ORACLES["dim_student"] = """
SELECT student_id, first_name || ' ' || last_name AS full_name, first_name, last_name, document_number, gender, email, course_id,
  enrollment_date, status FROM c_students"""
CTES["dates"] = """
SELECT dt AS date_key, CAST(year(dt) AS INTEGER) AS year, CAST(month(dt) AS INTEGER) AS month, monthname(dt) AS month_name,
  CAST(day(dt) AS INTEGER) AS day, dayname(dt) AS day_of_week, CAST(quarter(dt) AS INTEGER) AS quarter,
  CASE WHEN month(dt) <= 6 THEN 1 ELSE 2 END AS semester
FROM (SELECT submission_date AS dt FROM c_grades UNION SELECT assessment_date FROM c_assessments UNION SELECT enrollment_date FROM c_students)
WHERE dt IS NOT NULL"""
ORACLES["dim_date"] = "SELECT * FROM dates"
ORACLES["kpis"] = """
SELECT total_students, average_gpa, pass_rate_percentage, total_evaluations, total_subjects,
  CAST(100 - pass_rate_percentage AS DECIMAL(5,2)) AS fail_rate_percentage FROM (
SELECT (SELECT count(*) FROM student_perf) AS total_students,
  (SELECT CAST(round_even(CAST(CAST(sum(overall_average) AS DECIMAL(18,2)) / count(*) AS DECIMAL(18,8)), 2) AS DECIMAL(5,2)) FROM student_perf) AS average_gpa,
  CAST(round_even(CAST(sum(CASE WHEN is_approved THEN 1 ELSE 0 END) * 100.0 / count(*) AS DECIMAL(18,8)), 2) AS DECIMAL(5,2)) AS pass_rate_percentage,
  count(*) AS total_evaluations, (SELECT count(*) FROM subject_perf) AS total_subjects FROM final)"""
ORACLES["report_card"] = """
SELECT f.student_id, f.full_name, f.course_id, f.course_name, f.subject_name, f.department, f.period_id, f.final_grade, f.is_approved,
  f.approval_status, p.overall_average, p.academic_ranking_overall, p.academic_ranking_in_course, p.performance_category
FROM final f JOIN student_perf p ON f.student_id = p.student_id AND f.course_id IS NOT DISTINCT FROM p.course_id WHERE f.student_id = '7'"""

# Scalar cleaning and predicates
ORACLES["clean_scores"] = f"""
SELECT grade_id, CAST(_copy AS INTEGER) AS copy, {dec_text('score')} AS score, TRY_CAST(replace(trim(score), ',', '.') AS DOUBLE) AS score_double,
  coalesce(regexp_matches(score, {NUM}), false) AS is_numeric, coalesce(({dec_text('score')}) BETWEEN 0 AND 5, false) AS in_range,
  coalesce(submission_date IS NULL OR trim(submission_date) = '' OR ({iso_date('submission_date')}) <= {TODAY}, false) AS date_ok,
  nullif(trim(feedback), '') AS feedback, CASE WHEN trim(feedback) NOT IN ('', 'nan', 'None') THEN feedback END AS feedback_raw,
  {json_kept('extra')} AS extra FROM raw_grades"""
CTES["births"] = f"SELECT *, CAST(try_strptime(trim(birth_date), {FORMATS}) AS DATE) AS born FROM raw_students"
ORACLES["parse_dates"] = f"""
SELECT _k AS k, CAST(_copy AS INTEGER) AS copy, born AS parsed,
  CASE WHEN birth_date IS NULL OR trim(birth_date) = '' THEN '' ELSE coalesce(strftime(born, '%Y-%m-%d'), trim(birth_date)) END AS canonical,
  {iso_date('birth_date')} AS iso_only, coalesce(year(born) >= 1920 AND born <= {TODAY}, false) AS plausible FROM births"""
_NEAT = r"trim(regexp_replace(first_name, '\s+', ' ', 'g'))"
ORACLES["gender_codes"] = f"""
SELECT _k AS k, CAST(_copy AS INTEGER) AS copy, {gender('gender')} AS gender, {gender('gender', "'fem', ")} AS gender_wide, {_NEAT} AS first_name,
  nullif(lower(trim(email)), '') AS email, coalesce(nullif(upper(trim(status)), ''), 'ACTIVO') AS status,
  {_NEAT} || ' ' || trim(last_name) AS full_name, {whole('course_id')} AS course_number FROM raw_students"""
ORACLES["normalize_headers"] = f"SELECT doc_id, {header('text')} AS header FROM documents"
ORACLES["normalize_headers_arrow"] = f"SELECT conv_id, turn, {header('text')} AS header FROM conversations"
ORACLES["text_filter"] = "SELECT doc_id, lang, source FROM documents WHERE contains(lower(concat_ws(' ', text, lang, source)), 'ment')"
ORACLES["department_filter"] = "SELECT student_id, subject_id, period_id, final_grade FROM final WHERE department = 'Brand#1'"
ORACLES["cohort_filter"] = "SELECT student_id, overall_average, ranking_position FROM cohorts WHERE contains(cohort_group, 'Top')"
ORACLES["bands"] = """
SELECT CASE WHEN score >= 4.5 THEN 'Excelente (Cuadro de Honor)' WHEN score >= 4.0 THEN 'Sobresaliente' WHEN score >= 3.0 THEN 'Aceptable'
  ELSE 'Bajo / En Riesgo Académico' END AS band, CASE WHEN is_passing THEN 'APROBADO' ELSE 'REPROBADO' END AS verdict, count(*) AS n
FROM fact GROUP BY 1, 2"""

# Validation and quarantine
CTES["l_courses"] = """
SELECT *, CASE WHEN course_id IS NULL OR trim(course_id) = '' THEN 'Null or empty course_id'
  WHEN rn > 1 THEN 'Duplicate course_id primary key: ' || course_id END AS error_reason
FROM (SELECT *, row_number() OVER (PARTITION BY course_id ORDER BY _k) AS rn FROM raw_courses)"""
CTES["l_subjects"] = """
SELECT *, CASE WHEN subject_id IS NULL OR trim(subject_id) = '' THEN 'Null or empty subject_id'
  WHEN subject_name IS NULL OR trim(subject_name) = '' THEN 'Null or empty subject_name'
  WHEN rn > 1 THEN 'Duplicate subject_id: ' || subject_id END AS error_reason
FROM (SELECT *, row_number() OVER (PARTITION BY subject_id ORDER BY _k) AS rn FROM raw_subjects)"""
_FIXED_GENDER = f"CASE WHEN ({gender('gender', chr(39) + 'fem' + chr(39) + ', ')}) IN ('M', 'F') AND ({gender('gender', chr(39) + 'fem' + chr(39) + ', ')}) <> trim(gender) THEN ({gender('gender', chr(39) + 'fem' + chr(39) + ', ')}) ELSE gender END"


def label_students(courses: str) -> str:
    return f"""
SELECT _k, _copy, student_id, document_number, course_id, birth_date, first_name AS first_name_raw, gender AS gender_raw,
  CASE WHEN {_NEAT} <> first_name THEN {_NEAT} ELSE first_name END AS first_name, {_FIXED_GENDER} AS gender,
  CASE WHEN student_id IS NULL OR trim(student_id) = '' THEN 'Null or empty student_id'
  WHEN trim(birth_date) <> '' AND born IS NULL THEN 'Invalid birth_date format: ''' || birth_date || ''''
  WHEN trim(birth_date) <> '' AND (year(born) < 1920 OR born > {TODAY}) THEN 'Impossible birth_date: ''' || birth_date || ''' (out of biological bounds)'
  WHEN trim(course_id) <> '' AND trim(course_id) NOT IN (SELECT trim(course_id) FROM {courses}) THEN 'curso_id inexistente (' || trim(course_id) || ')'
  WHEN dup_id > 1 THEN 'estudiante_id duplicado: ' || student_id
  WHEN document_number IS NOT NULL AND trim(document_number) <> '' AND dup_doc > 1 THEN 'documento duplicado: ' || document_number END AS error_reason
FROM (SELECT *, row_number() OVER (PARTITION BY student_id ORDER BY _k, _copy) AS dup_id,
  row_number() OVER (PARTITION BY document_number ORDER BY _k, _copy) AS dup_doc FROM births)"""


def label_assessments(subjects: str) -> str:
    return f"""
SELECT r.*, CASE WHEN r.row_reason IS NOT NULL THEN r.row_reason WHEN abs(g.total - 100) > 0.5 AND abs(g.total - 1) > 0.01 THEN
  'pesos de evaluación del grupo (''' || r.subject_id || ''', ''' || r.period_id || ''') suman ' || CAST(CAST(g.total AS DOUBLE) AS VARCHAR)
  || '%, esperado 100%' END AS error_reason
FROM {{rows}} r LEFT JOIN (SELECT subject_id, period_id, sum(CAST(w AS DECIMAL(18,6))) AS total FROM {{rows}} WHERE row_reason IS NULL GROUP BY 1, 2) g
ON r.subject_id = g.subject_id AND r.period_id = g.period_id""".replace("{rows}", f"({_assessment_rows(subjects)})")


def _assessment_rows(subjects: str) -> str:
    return f"""
SELECT *, CASE WHEN trim(assessment_id) = '' THEN 'Null or empty assessment_id' WHEN trim(assessment_name) = '' THEN 'Null or empty assessment_name'
  WHEN w < 0 OR w > 100 THEN 'Weight percentage out of allowed range [0-100%]: ' || CAST(w AS VARCHAR)
  WHEN w IS NULL THEN 'Non-numeric weight percentage: ''' || trim(weight_percentage) || ''''
  WHEN trim(subject_id) NOT IN (SELECT trim(subject_id) FROM {subjects}) THEN 'Foreign key violation: subject_id ''' || trim(subject_id) || ''' does not exist'
  WHEN rn > 1 THEN 'Duplicate assessment_id: ' || assessment_id END AS row_reason
FROM (SELECT *, TRY_CAST(replace(trim(weight_percentage), ',', '.') AS DOUBLE) AS w,
  row_number() OVER (PARTITION BY assessment_id ORDER BY _k1, _k2, _k3, _k4) AS rn FROM raw_assessments)"""


def label_grades(students: str, assessments: str) -> str:
    return f"""
SELECT *, CASE WHEN rn > 1 THEN 'fila duplicada' WHEN score IS NULL OR trim(score) = '' THEN 'nota nula'
  WHEN v < 0 OR v > 5 THEN 'nota fuera de rango (' || CAST(v AS VARCHAR) || ')' WHEN v IS NULL THEN 'nota no numérica (''' || score || ''')'
  WHEN student_id NOT IN (SELECT student_id FROM {students}) THEN 'estudiante_id inexistente (' || student_id || ')'
  WHEN assessment_id NOT IN (SELECT assessment_id FROM {assessments}) THEN 'evaluacion_id inexistente (' || assessment_id || ')'
  WHEN day IS NULL THEN 'fecha inválida (texto ''' || submission_date || ''')' WHEN day > {TODAY} THEN 'fecha futura (' || submission_date || ')' END AS error_reason
FROM (SELECT *, TRY_CAST(replace(trim(score), ',', '.') AS DOUBLE) AS v, CAST(try_strptime(submission_date, {FORMATS}) AS DATE) AS day,
  row_number() OVER (PARTITION BY student_id, assessment_id, score, submission_date ORDER BY grade_id, _copy) AS rn FROM raw_grades)"""


CTES["l_students"] = label_students("c_courses")
CTES["l_assessments"] = label_assessments("c_subjects")
CTES["l_grades"] = label_grades("c_students", "c_assessments")
CTES["l_attendance"] = """
SELECT *, CASE WHEN student_id IS NULL OR trim(student_id) = '' THEN 'Null or empty student_id' WHEN t IS NULL OR a IS NULL THEN 'Valores de asistencia no enteros'
  WHEN a < 0 THEN 'inasistencias negativas' WHEN a > t THEN 'inasistencias > días de clase' END AS error_reason
FROM (SELECT *, trunc(TRY_CAST(total_classes AS DOUBLE)) AS t, trunc(TRY_CAST(absences AS DOUBLE)) AS a FROM raw_attendance)"""
ORACLES["validate_courses"] = "SELECT _k AS k, course_id, course_name, error_reason FROM l_courses"
ORACLES["validate_subjects"] = "SELECT _k AS k, subject_id, subject_name, error_reason FROM l_subjects"
ORACLES["validate_students"] = "SELECT _k AS k, CAST(_copy AS INTEGER) AS copy, student_id, first_name, gender, course_id, error_reason FROM l_students"
ORACLES["validate_assessments"] = "SELECT _k1 AS k1, _k2 AS k2, assessment_id, weight_percentage, error_reason FROM l_assessments"
ORACLES["validate_grades"] = """
SELECT grade_id, CAST(_copy AS INTEGER) AS copy, student_id, assessment_id, score, submission_date, error_reason FROM l_grades"""
ORACLES["validate_attendance"] = "SELECT attendance_id, total_classes, absences, error_reason FROM l_attendance"
_COMMA = r"regexp_matches(trim(score), '^-?\d+,\d+$')"
ORACLES["valid_grades"] = f"""
SELECT grade_id, assessment_id, student_id, CASE WHEN {_COMMA} THEN replace(trim(score), ',', '.') ELSE score END AS score, submission_date,
  feedback, extra FROM l_grades WHERE error_reason IS NULL"""


def corrections(students: str, grades: str) -> str:
    return f"""
SELECT 'students' AS entity, student_id AS id, 'first_name' AS field, first_name_raw AS original, first_name AS corrected,
  'Espacios y formato en nombre corregidos' AS reason FROM {students} WHERE first_name <> first_name_raw
UNION ALL SELECT 'students', student_id, 'gender', trim(gender_raw), gender, 'Normalización de género a estándar (''M''/''F'')'
FROM {students} WHERE gender <> gender_raw
UNION ALL SELECT 'grades', grade_id, 'score', trim(score), replace(trim(score), ',', '.'),
  'Conversión de decimal con coma ''' || trim(score) || ''' a formato punto ''' || replace(trim(score), ',', '.') || ''''
FROM {grades} WHERE rn = 1 AND {_COMMA}"""


ORACLES["corrections_log"] = corrections("l_students", "l_grades")
ORACLES["error_reasons"] = "SELECT 'grades' AS entity, error_reason, count(*) AS error_count FROM l_grades WHERE error_reason IS NOT NULL GROUP BY 2"
CTES["v_students"] = label_students("(SELECT course_id FROM l_courses WHERE error_reason IS NULL)")
CTES["v_assessments"] = label_assessments("(SELECT subject_id FROM l_subjects WHERE error_reason IS NULL)")
CTES["v_grades"] = label_grades(
    "(SELECT trim(student_id) AS student_id FROM v_students WHERE error_reason IS NULL)",
    "(SELECT trim(assessment_id) AS assessment_id FROM v_assessments WHERE error_reason IS NULL)",
)
_CHAIN = {"courses": "l_courses", "subjects": "l_subjects", "students": "v_students", "assessments": "v_assessments", "grades": "v_grades", "attendance": "l_attendance"}
ORACLES["validation_summary"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, count(*) AS total, {count_where('error_reason IS NULL')} AS valid, {count_where('error_reason IS NOT NULL')} AS errors FROM {t}"
    for e, t in _CHAIN.items()
)
ORACLES["error_sample"] = (
    "SELECT 'attendance' AS entity, (SELECT count(*) FROM l_attendance WHERE error_reason IS NOT NULL) AS error_total, "
    + ", ".join(f"coalesce({c}, '') AS {c}" for c in [*COLUMNS["attendance"], "error_reason"])
    + " FROM l_attendance WHERE error_reason IS NOT NULL ORDER BY attendance_id LIMIT 50"
)
ORACLES["required_columns"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, '{c}' AS column_name, true AS present, {count_where(f'''{c} IS NULL OR trim({c}) IN ('', 'nan', 'None')''')} AS blank_count FROM raw_{e}"
    for e, cs in REQUIRED.items() for c in cs
) + "".join(f" UNION ALL SELECT '{e}', 'missing_column', false, NULL" for e in REQUIRED)
ORACLES["weight_sum"] = """
SELECT subject_id, period_id, CAST(sum(weight_percentage) AS DECIMAL(18,2)) AS total, CAST(sum(weight_percentage) - 100 AS DECIMAL(18,2)) AS deviation
FROM c_assessments GROUP BY 1, 2"""
ORACLES["orphans"] = "SELECT o_orderkey, o_custkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)"
ORACLES["unlabelled_documents"] = "SELECT doc_id, lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)"
ORACLES["duplicate_texts"] = "SELECT doc_id, sha256(text) AS digest FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) > 1)"
ORACLES["flagged_duplicates"] = """
SELECT doc_id, length(text) > 0 AND row_number() OVER (PARTITION BY text ORDER BY doc_id) > 1 AS is_duplicate FROM documents"""
ORACLES["duplicate_keys"] = "SELECT l_orderkey, l_linenumber, count(*) AS copies FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"

# Staging
CTES["st_courses"] = firsts("raw_courses", "trim(course_id)", "_k", "trim(course_id) <> ''", {
    "course_id": "trim(course_id)", "course_name": "trim(course_name)", "grade_level": whole("grade_level"),
    "academic_year": whole("academic_year"), "extra": json_kept("extra"),
})
CTES["st_subjects"] = firsts("raw_subjects", "trim(subject_id)", "_k", "trim(subject_id) <> ''", {
    "subject_id": "trim(subject_id)", "subject_name": "trim(subject_name)", "course_id": "nullif(trim(course_id), '')",
    "department": "nullif(trim(department), '')", "extra": json_kept("extra"),
})
CTES["st_students"] = firsts("raw_students", "trim(student_id)", "_k, _copy", "trim(student_id) <> ''", {
    "student_id": "trim(student_id)", "document_number": "nullif(trim(document_number), '')", "first_name": "trim(first_name)",
    "last_name": "trim(last_name)", "gender": gender("gender"), "birth_date": iso_date("birth_date"), "email": "nullif(lower(trim(email)), '')",
    "course_id": "nullif(trim(course_id), '')", "enrollment_date": iso_date("enrollment_date"),
    "status": "coalesce(nullif(upper(trim(status)), ''), 'ACTIVO')", "extra": json_kept("extra"),
})
CTES["st_assessments_all"] = firsts(
    "raw_assessments", "trim(assessment_id)", "_k1, _k2, _k3, _k4",
    f"trim(assessment_id) <> '' AND trim(assessment_name) <> '' AND ({dec_text('weight_percentage')}) BETWEEN 0 AND 100", {
        "assessment_id": "trim(assessment_id)", "course_id": "nullif(trim(course_id), '')", "subject_id": "nullif(trim(subject_id), '')",
        "period_id": "nullif(trim(period_id), '')", "assessment_name": "trim(assessment_name)", "assessment_type": "nullif(trim(assessment_type), '')",
        "weight_percentage": dec_text("weight_percentage"), "assessment_date": iso_date("assessment_date"), "extra": json_kept("extra"),
    })
CTES["st_assessments"] = """
SELECT a.* FROM st_assessments_all a JOIN (SELECT coalesce(subject_id, '') AS s, coalesce(period_id, '') AS p, sum(weight_percentage) AS w
  FROM st_assessments_all GROUP BY 1, 2) g ON coalesce(a.subject_id, '') = g.s AND coalesce(a.period_id, '') = g.p WHERE abs(g.w - 100) <= 1"""
_DATE_OK = f"(submission_date IS NULL OR trim(submission_date) = '' OR ({iso_date('submission_date')}) <= {TODAY})"
CTES["st_grades"] = firsts(
    "raw_grades", "trim(assessment_id), trim(student_id)", "grade_id, _copy",
    f"trim(grade_id) <> '' AND ({dec_text('score')}) BETWEEN 0 AND 5 AND {_DATE_OK} AND trim(student_id) IN (SELECT student_id FROM st_students) "
    "AND trim(assessment_id) IN (SELECT assessment_id FROM st_assessments)", {
        "grade_id": "trim(grade_id)", "assessment_id": "trim(assessment_id)", "student_id": "trim(student_id)", "score": dec_text("score"),
        "submission_date": iso_date("submission_date"), "feedback": "nullif(trim(feedback), '')", "extra": json_kept("extra"),
    })
for _e in ("courses", "subjects", "students", "assessments", "grades"):
    ORACLES[f"stage_{_e}"] = f"SELECT * FROM st_{_e}"


def _loose_date(c: str) -> str:
    return rf"CASE WHEN regexp_matches({c}, '^\d{{4}}-\d{{2}}-\d{{2}}') THEN TRY_CAST(TRY_CAST(trim({c}) AS TIMESTAMP) AS DATE) END"


ORACLES["stage_periods"] = f"""
SELECT DISTINCT trim(period_id) AS period_id, trim(period_name) AS period_name, {_loose_date('start_date')} AS start_date,
  {_loose_date('end_date')} AS end_date, {dec_text('weight')} AS weight, {json_kept('extra')} AS extra FROM raw_periods WHERE trim(period_id) <> ''"""
_INT = "TRY_CAST(CASE WHEN regexp_matches(trim({0}), '^[+-]?[0-9]+$') THEN trim({0}) END AS INTEGER)"
ORACLES["stage_attendance"] = rf"""
SELECT trim(attendance_id) AS attendance_id, trim(student_id) AS student_id, nullif(trim(course_id), '') AS course_id,
  nullif(trim(period_id), '') AS period_id, CASE WHEN regexp_matches(total_classes, '^\d+$') THEN TRY_CAST(total_classes AS INTEGER) END AS total_classes,
  CASE WHEN regexp_matches(absences, '^\d+$') THEN TRY_CAST(absences AS INTEGER) END AS absences, {json_kept('extra')} AS extra
FROM raw_attendance WHERE trim(student_id) <> '' AND {_INT.format('absences')} BETWEEN 0 AND {_INT.format('total_classes')}"""

# Silver, sources and sinks
ORACLES["upsert"] = """
WITH o AS (SELECT o_orderkey, o_orderstatus, o_orderpriority, CAST(o_orderdate AS DATE) AS o_orderdate FROM orders),
t AS (SELECT * FROM o WHERE o_orderdate < DATE '2000-01-01'), s AS (SELECT * FROM o WHERE o_orderdate >= DATE '1997-01-01')
SELECT s.o_orderkey, lower(s.o_orderstatus) AS o_orderstatus, s.o_orderpriority, s.o_orderdate,
  CASE WHEN t.o_orderkey IS NULL THEN DATE '2026-02-01' ELSE DATE '2026-01-01' END AS created_at, DATE '2026-02-01' AS updated_at
FROM s LEFT JOIN t ON s.o_orderkey = t.o_orderkey
UNION ALL SELECT *, DATE '2026-01-01', DATE '2026-01-01' FROM t WHERE o_orderkey NOT IN (SELECT o_orderkey FROM s)"""
ORACLES["upsert_ranges"] = """
SELECT o_orderkey, o_custkey, CASE WHEN late THEN lower(o_orderstatus) ELSE o_orderstatus END AS o_orderstatus, o_totalprice, CAST(o_orderdate AS DATE) AS o_orderdate, o_orderpriority,
  DATE '2026-01-01' AS created_at, CASE WHEN late THEN DATE '2026-02-01' ELSE DATE '2026-01-01' END AS updated_at, true AS few_ranges
FROM (SELECT *, o_orderkey > (SELECT max(o_orderkey) - max(o_orderkey) // 100 FROM orders) AS late FROM orders)"""
ORACLES["cascade_delete"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus <> 'P')"""
ORACLES["land_raw"] = (
    "SELECT " + ", ".join(f"CASE WHEN trim({c}) NOT IN ('', 'nan', 'None') THEN {c} END AS {c}" for c in COLUMNS["grades"])
    + ", 'grades.csv' AS source_file FROM raw_grades"
)
ORACLES["row_audit"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in TABLES)
ORACLES["set_difference"] = "SELECT p_partkey AS part_key FROM part EXCEPT SELECT l_partkey FROM lineitem"
ORACLES["set_equality"] = """
SELECT count(*) AS grades, NOT EXISTS (SELECT assessment_id FROM c_grades EXCEPT SELECT assessment_id FROM c_assessments)
  AND NOT EXISTS (SELECT assessment_id FROM c_assessments EXCEPT SELECT assessment_id FROM c_grades) AS same FROM c_grades"""


# Profiling, detection, mapping
def profile_sql(name: str, columns: dict[str, str], source: str) -> str:
    """``columns``: name to 'value' or 'date'."""
    cells = " UNION ALL ".join(f"SELECT '{c}' AS c, '{k}' AS k, CAST({c} AS VARCHAR) AS v FROM {source}" for c, k in columns.items())
    day = (
        r"CASE WHEN regexp_matches(trim(v), '^\d{4}[-/]\d{1,2}[-/]\d{1,2}') THEN "
        r"TRY_CAST(replace(regexp_extract(trim(v), '^\d{4}[-/]\d{1,2}[-/]\d{1,2}'), '/', '-') AS DATE) END"
    )
    return rf"""
WITH cells AS ({cells}),
t AS (SELECT c, k, v, v IS NOT NULL AND trim(v) <> '' AND v <> 'nan' AS f, CASE WHEN k = 'value' THEN TRY_CAST(replace(trim(v), ',', '.') AS DOUBLE) END AS num FROM cells),
u AS (SELECT *, CASE WHEN f AND num IS NULL THEN {day} END AS d FROM t),
s AS (SELECT c, count(*) AS total_rows, count(*) FILTER (NOT f) AS null_count, count(DISTINCT v) FILTER (f) AS unique_count,
  count(num) FILTER (f) AS nums, count(d) AS days, bool_and(num = floor(num)) FILTER (f) AS allint, min(num) FILTER (f) AS lo, max(num) FILTER (f) AS hi,
  min(d) AS dlo, max(d) AS dhi, coalesce(bool_or(regexp_matches(trim(v), '^-?\d+,\d+$')) FILTER (f), false) AS comma FROM u GROUP BY c),
q AS (SELECT c, string_agg(v, '|' ORDER BY v) AS samples FROM (SELECT c, v, row_number() OVER (PARTITION BY c ORDER BY v) AS rn FROM (SELECT DISTINCT c, v FROM u WHERE f)) WHERE rn <= 5 GROUP BY c),
x AS (SELECT *, total_rows - null_count AS ok, CASE WHEN total_rows = null_count THEN 'empty' WHEN nums * 100 >= 80 * (total_rows - null_count) THEN
  CASE WHEN allint THEN 'integer' ELSE 'float' END WHEN days * 100 >= 80 * (total_rows - null_count) THEN 'date' ELSE 'string' END AS kind FROM s)
SELECT '{name}' AS table_name, x.c AS column_name, kind AS inferred_type, total_rows, null_count, {rate2('null_count', 'total_rows')} AS null_percentage,
  unique_count, unique_count = ok AND ok > 0 AS is_unique, CASE WHEN kind IN ('integer', 'float') THEN lo END AS min_number,
  CASE WHEN kind IN ('integer', 'float') THEN hi END AS max_number, CASE WHEN kind = 'date' THEN dlo END AS min_date,
  CASE WHEN kind = 'date' THEN dhi END AS max_date, coalesce(samples, '') AS sample_values, comma AS has_comma_floats FROM x LEFT JOIN q ON x.c = q.c"""


ORACLES["profile_events"] = profile_sql("events", {"event_id": "value", "ts": "date", "user_id": "value", "event_type": "value", "value": "value", "props": "value"}, "events")
ORACLES["profile_orders"] = profile_sql(
    "orders", {"o_orderkey": "value", "o_custkey": "value", "o_orderstatus": "value", "o_totalprice": "value", "o_orderdate": "date", "o_orderpriority": "value"}, "orders")
ORACLES["profile_raw_grades"] = profile_sql("grades", {c: "value" for c in COLUMNS["grades"]}, "raw_grades")


def dictionary_sql(name: str, columns: list[tuple[str, str, bool]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS table_name, '{c}' AS column_name, '{dtype}' AS dtype, count(*) FILTER ({c} IS NULL) AS null_count, "
        f"{rate2(f'count(*) FILTER ({c} IS NULL)', 'count(*)')} AS null_pct, count(DISTINCT {c}) + CAST(bool_or({c} IS NULL) AS BIGINT) AS unique_count, "
        f"coalesce(min(CAST({c} AS VARCHAR)), 'N/A') AS sample_value, "
        + (f"CAST(min({c}) AS DOUBLE) AS min_number, CAST(max({c}) AS DOUBLE) AS max_number, " if number else "NULL, NULL, ")
        + (f"count(*) - count(DISTINCT {c}) AS duplicate_keys" if i == 0 else "NULL")
        + f" FROM {name}"
        for i, (c, dtype, number) in enumerate(columns)
    )


ORACLES["data_dictionary"] = dictionary_sql("customer", [
    ("c_custkey", "bigint", True), ("c_name", "string", False), ("c_nationkey", "int", True), ("c_acctbal", "double", True), ("c_mktsegment", "string", False)])

CTES["word_spots"] = """
SELECT source AS workbook, CAST(doc_id AS VARCHAR) AS doc, w AS column_name, min(i) AS position FROM (
  SELECT source, doc_id, unnest(ws) AS w, unnest(range(len(ws))) AS i FROM (SELECT source, doc_id, regexp_split_to_array(lower(text), '[^a-zà-ÿ]+') AS ws FROM documents))
WHERE w <> '' GROUP BY ALL"""
_NAMES = "['notas', 'mis_alumnos', 'Evaluación 1', 'curso', 'diccionario', 'asistencia', 'Periodo']"
CTES["word_catalog"] = f"""
SELECT workbook, {_NAMES}[CAST(CAST(doc AS BIGINT) % 7 AS INTEGER) + 1] || ' ' || doc AS table_name, CAST(doc AS BIGINT) AS table_position, column_name, position FROM word_spots"""


def _values(rows: list[tuple]) -> str:
    return "VALUES " + ", ".join("(" + ", ".join(f"'{x}'" if isinstance(x, str) else str(x) for x in r) + ")" for r in rows)


_MARKS = sorted({(e, f, w) for e, fs in FIELD_WORDS.items() for f, ws in fs.items() for w in ws}
                | {(e, f"#{i}", w) for e, (_, _, sets) in BONUS.items() for i, ws in enumerate(sets) for w in ws})
_ENTITIES = [
    (i, e, len(FIELD_WORDS[e]), BONUS[e][0] if e in BONUS else 0.0, (len(BONUS[e][2]) if BONUS[e][1] == "all" else 1) if e in BONUS else 99)
    for i, e in enumerate(TABLE_WORDS)]
_HINTS = [(e, w) for e, ws in TABLE_WORDS.items() for w in ws]
_FIELDS = [(e, i, f, j, w) for e, fs in FIELD_WORDS.items() for i, (f, ws) in enumerate(fs.items()) for j, w in enumerate(ws)]


def scores_sql(catalog: str) -> str:
    return f"""
SELECT * FROM (SELECT workbook, table_name, table_position, entity, entity_position, least(1.0, round(CAST(by_name AS DOUBLE) + (coalesce(fields, 0)::DOUBLE / n * 0.4::DOUBLE
  + CASE WHEN coalesce(sets, 0) >= need THEN CAST(bonus AS DOUBLE) ELSE 0 END), 2))::DOUBLE AS score
FROM (SELECT workbook, table_name, table_position, entity, max(CASE WHEN nm = word THEN 0.6 WHEN contains(nm, word) OR contains(word, nm) THEN 0.4 ELSE 0.0 END) AS by_name
  FROM (SELECT DISTINCT workbook, table_name, table_position, {header('table_name')} AS nm FROM {catalog}) JOIN ({_values(_HINTS)}) hints(entity, word) ON true
  WHERE {' AND '.join(f"NOT contains(nm, '{w}')" for w in IGNORED_TABLE_WORDS)} GROUP BY ALL)
JOIN ({_values(_ENTITIES)}) ents(entity_position, entity, n, bonus, need) USING (entity)
LEFT JOIN (SELECT workbook, table_name, entity, count(*) FILTER (NOT starts_with(mark, '#')) AS fields, count(*) FILTER (starts_with(mark, '#')) AS sets
  FROM (SELECT DISTINCT workbook, table_name, entity, mark FROM (SELECT DISTINCT workbook, table_name, {header('column_name')} AS word FROM {catalog})
    JOIN ({_values(_MARKS)}) marks(entity, mark, word) USING (word)) GROUP BY 1, 2, 3) USING (workbook, table_name, entity)) WHERE score > 0"""


def best_pairs_sql(offers: str, group: str, a: str, b: str) -> str:
    """Best free pair by best free pair: each step takes the first offer (by rk) whose two sides are both free."""
    return f"""
WITH RECURSIVE offer AS MATERIALIZED ({offers}),
step AS (
  SELECT {group}, [{a}] AS used_a, [{b}] AS used_b, rk FROM offer WHERE rk = 1
  UNION ALL
  SELECT {group}, list_append(any_value(used_a), arg_min({a}, offer.rk)), list_append(any_value(used_b), arg_min({b}, offer.rk)), min(offer.rk) AS rk
  FROM step JOIN offer USING ({group}) WHERE offer.rk > step.rk AND NOT list_contains(used_a, {a}) AND NOT list_contains(used_b, {b}) GROUP BY {group})
SELECT offer.* FROM offer JOIN step USING ({group}, rk)"""


def assigned_sql(catalog: str, minimum: float) -> str:
    ranked = f"SELECT *, row_number() OVER (PARTITION BY workbook ORDER BY score DESC, table_position, entity_position) AS rk FROM ({scores_sql(catalog)}) WHERE score >= {minimum}"
    return best_pairs_sql(ranked, "workbook", "table_name", "entity")


def mapped_sql(catalog: str, assigned: str) -> str:
    options = f"""
SELECT workbook, table_name, entity, column_name, position, place, field, max(CASE WHEN head = word THEN CASE WHEN nth = 0 OR head = field THEN 1.0 ELSE 0.95 END
  WHEN contains(head, word) OR contains(word, head) THEN 0.7 END)::DOUBLE AS confidence
FROM (SELECT *, {header('column_name')} AS head FROM {catalog} JOIN (SELECT workbook, table_name, entity FROM ({assigned})) USING (workbook, table_name))
JOIN ({_values(_FIELDS)}) words(entity, place, field, nth, word) USING (entity) GROUP BY ALL"""
    group = "workbook, table_name, entity"
    ranked = f"SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY confidence DESC, position, place) AS rk FROM ({options}) WHERE confidence IS NOT NULL"
    return best_pairs_sql(ranked, group, "column_name", "field")


def sheets_sql(catalog: str, counts: str, minimum: float) -> str:
    assigned = assigned_sql(catalog, minimum)
    return f"""
SELECT c.workbook, c.table_name, c.entity, coalesce(c.score, 0) AS confidence, n AS row_count,
  coalesce(string_agg(column_name || '=' || field, '|' ORDER BY column_name || '=' || field) FILTER (field IS NOT NULL), '') AS mapping,
  coalesce(string_agg(column_name, '|' ORDER BY position) FILTER (field IS NULL AND c.entity IS NOT NULL), '') AS ignored
FROM (SELECT * FROM {catalog} LEFT JOIN (SELECT workbook, table_name, entity, score FROM ({assigned})) USING (workbook, table_name)) c
LEFT JOIN (SELECT workbook, table_name, column_name, field FROM ({mapped_sql(catalog, assigned)})) USING (workbook, table_name, column_name)
JOIN {counts} USING (workbook, table_name) GROUP BY ALL"""


ORACLES["score_tables"] = f"SELECT workbook, table_name, entity, score FROM ({scores_sql('word_catalog')})"
ORACLES["assign_entities"] = f"SELECT workbook, table_name, entity, score FROM ({assigned_sql('word_catalog', 0.1)})"
ORACLES["map_columns"] = f"SELECT workbook, table_name, entity, column_name, field, confidence FROM ({mapped_sql('word_catalog', assigned_sql('word_catalog', 0.1))})"


def _upload_catalog(books: dict[str, list[str]], names: dict[str, str], ordered: bool) -> str:
    rows = []
    for book, entities in books.items():
        placed = sorted(names[e] for e in entities) if ordered else [names[e] for e in entities]
        rows += [(book, names[e], placed.index(names[e]), c, i) for e in entities for i, c in enumerate(uploaded_columns(e))]
    return f"SELECT * FROM ({_values(rows)}) t(workbook, table_name, table_position, column_name, position)"


def _upload_counts(books: dict[str, list[str]], names: dict[str, str]) -> str:
    return "(" + " UNION ALL ".join(f"SELECT '{b}' AS workbook, '{names[e]}' AS table_name, count(*) AS n FROM raw_{e}" for b, es in books.items() for e in es) + ")"


CTES["one_book"] = _upload_catalog({"workbook": list(UPLOAD_NAMES)}, UPLOAD_NAMES, False)
CTES["two_books"] = _upload_catalog(UPLOAD_BOOKS, UPLOAD_NAMES, True)
ORACLES["propose_mapping"] = sheets_sql("one_book", _upload_counts({"workbook": list(UPLOAD_NAMES)}, UPLOAD_NAMES), 0.4)
ORACLES["propose_uploads"] = sheets_sql("two_books", _upload_counts(UPLOAD_BOOKS, UPLOAD_NAMES), 0.4)
ORACLES["ingest_uploads"] = f"""
SELECT table_name, entity, row_count AS raw_rows, row_count AS stored_rows, CAST(row_count AS BIGINT) AS listed_rows, len(string_split(mapping, '|')) AS mapped_columns
FROM ({ORACLES["propose_mapping"]})"""
ORACLES["detect_scale"] = """
SELECT CASE WHEN q <= 5.2 THEN '0-5' WHEN q <= 10.5 THEN '0-10' ELSE '0-100' END AS scale_type, CAST(0 AS DOUBLE) AS min_grade,
  CAST(CASE WHEN q <= 5.2 THEN 5 WHEN q <= 10.5 THEN 10 ELSE 100 END AS DOUBLE) AS max_grade,
  CAST(CASE WHEN q <= 5.2 THEN 3 WHEN q <= 10.5 THEN 6 ELSE 60 END AS DOUBLE) AS passing_grade
FROM (SELECT quantile_cont(TRY_CAST(replace(trim(score), ',', '.') AS DOUBLE), 0.99) AS q FROM raw_grades)"""

# Levels of the driver's parts as a scale: a level per type, its bounds from the parts' sizes.
ORACLES["detect_scale_table"] = """
SELECT CASE WHEN hi <= 5.5 THEN '0-5' WHEN hi <= 10.5 THEN '0-10' ELSE '0-100' END AS scale_type, CAST(0 AS DOUBLE) AS min_grade, hi AS max_grade, basic AS passing_grade
FROM (SELECT max(CAST(p_size AS DOUBLE)) AS hi, quantile_cont(CAST(p_size AS DOUBLE) - 1, 0.5) AS basic FROM part)"""


def _share(place: int, rule: str, keys: str) -> str:
    return f"""SELECT {place} AS place, '{rule}' AS rule, '{keys}' AS group_cols,
  CAST(coalesce(round(CAST(count(*) FILTER (t BETWEEN 99 AND 101 OR t BETWEEN 0.99 AND 1.01) * 1.0 / nullif(count(*), 0) AS DECIMAL(18,8)), 4), 0) AS DECIMAL(5,4)) AS valid_group_ratio
FROM (SELECT sum(weight_percentage) AS t FROM c_assessments WHERE {' AND '.join(f'{k} IS NOT NULL' for k in keys.split(','))} GROUP BY {keys})"""


_SHARES = " UNION ALL ".join([
    _share(0, "by_subject_period", "subject_id,period_id"), _share(1, "by_course_subject_period", "course_id,subject_id,period_id"),
    _share(2, "by_subject", "subject_id"), _share(3, "by_period", "period_id")])
ORACLES["weight_rules"] = _SHARES
ORACLES["detect_weight_rule"] = f"SELECT rule, group_cols, valid_group_ratio FROM ({_SHARES}) ORDER BY valid_group_ratio DESC, place LIMIT 1"
ORACLES["pack_extra"] = """
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN '{"c_name":"' || c_name || '"}'
  ELSE '{"c_name":"' || c_name || '","c_mktsegment":"' || c_mktsegment || '"}' END AS extra FROM customer"""
ORACLES["apply_mapping"] = """
SELECT CAST(c_custkey AS VARCHAR) AS student_id, '' AS document_number, c_name AS first_name, '' AS last_name, '' AS gender, '' AS birth_date,
  '' AS email, CAST(c_nationkey AS VARCHAR) AS course_id, '' AS enrollment_date, '' AS status, '{"c_acctbal":"' || CAST(CAST(round(c_acctbal * 100) AS BIGINT) AS VARCHAR) || '","c_mktsegment":"' || c_mktsegment || '"}' AS extra FROM customer"""
ORACLES["sequence_id"] = """
SELECT printf('G-%06d', row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate, l_extendedprice)) AS grade_id,
  l_orderkey, l_linenumber, l_partkey, l_suppkey FROM lineitem"""
ORACLES["exact_quantiles"] = " UNION ALL ".join(
    f"SELECT CAST({p} AS DOUBLE) AS probability, round(quantile_cont(l_extendedprice, {p}), 4) AS quantile FROM lineitem" for p in (0.01, 0.5, 0.99)
)


# Reconciliation and assertions
def report_sql(chain: dict[str, str], fixes: dict[str, str], gold: dict[str, str]) -> str:
    entities = ["courses", "subjects", "students", "assessments", "grades", "attendance"]
    rows = []
    for e in entities:
        if e in chain:
            t = chain[e]
            rows.append(
                f"SELECT '{e}' AS entity, (SELECT count(*) FROM {t}) AS excel_rows, (SELECT count(*) FROM {t} WHERE error_reason IS NULL) AS valid_rows, "
                f"(SELECT count(*) FROM {t} WHERE error_reason IS NOT NULL) AS quarantined_rows, {fixes.get(e, 'CAST(0 AS BIGINT)')} AS normalized_rows, "
                + (f"(SELECT count(*) FROM {gold[e]})" if e in gold else f"(SELECT count(*) FROM {t} WHERE error_reason IS NULL)") + " AS gold_rows"
            )
        else:
            rows.append(f"SELECT '{e}', 0, 0, 0, 0, 0")
    return f"SELECT *, coalesce({rate2('quarantined_rows', 'excel_rows')}, 0.00) AS rejection_rate_pct FROM ({' UNION ALL '.join(rows)})"


_FIXES = {
    e: f"(SELECT count(*) FROM ({corrections('v_students', 'v_grades')}) WHERE entity = '{e}')" for e in ("students", "grades")
}
CTES["report"] = report_sql(_CHAIN, _FIXES, {"courses": "c_courses", "subjects": "c_subjects", "students": "c_students", "grades": "fact"})
ORACLES["reconcile_entities"] = "SELECT * REPLACE (CAST(rejection_rate_pct AS DECIMAL(5,2)) AS rejection_rate_pct) FROM report"
_METRICS = ["excel_rows", "valid_rows", "quarantined_rows", "normalized_rows", "gold_rows"]


def status_sql(scenario: str, threshold: float, grades: str = "gold_rows") -> str:
    gold = f"CASE WHEN entity = 'grades' THEN {grades} ELSE gold_rows END"
    return f"""
SELECT '{scenario}' AS scenario, {', '.join(f'total_{m}' for m in _METRICS)}, r AS overall_rejection_rate_pct, empty AS is_empty_load, r > {threshold} AS exceeds_threshold,
  CASE WHEN empty THEN 'ERROR' WHEN r > {threshold} THEN 'WARNING' ELSE 'SUCCESS' END AS status,
  CASE WHEN empty THEN 'La carga quedó vacía o no contiene calificaciones válidas cargadas en Gold.'
    WHEN r > {threshold} THEN 'Advertencia: la tasa de rechazo global (' || CAST(CAST(r AS DOUBLE) AS VARCHAR) || '%) supera el umbral configurado ({threshold}%).'
    ELSE 'Carga procesada exitosamente con una tasa de calidad del ' || CAST(CAST(100 - r AS DOUBLE) AS VARCHAR) || '%.' END AS message
FROM (SELECT {', '.join(f'CAST(sum({m}) AS BIGINT) AS total_{m}' for m in _METRICS)}, {rate2('sum(quarantined_rows)', 'sum(excel_rows)')} AS r,
  sum(excel_rows) = 0 OR sum(CASE WHEN entity = 'grades' THEN gold_rows ELSE 0 END) = 0 AS empty FROM (SELECT * REPLACE ({gold} AS gold_rows) FROM report))"""


ORACLES["reconcile_status"] = " UNION ALL ".join([
    status_sql("normal", 20.0), status_sql("strict", 1.0), status_sql("lenient", 99.0), status_sql("empty", 20.0, "0")])
ORACLES["rejection_reasons"] = " UNION ALL ".join(
    f"SELECT '{e}' AS entity, error_reason, count(*) AS error_count FROM l_{e} WHERE error_reason IS NOT NULL GROUP BY error_reason"
    for e in ("courses", "subjects", "students", "assessments", "grades", "attendance"))


# Sources and sinks: what is read back is what was written.
ORACLES["read_text_table"] = """
SELECT CAST(o_orderkey AS VARCHAR) AS o_orderkey, CAST(o_custkey AS VARCHAR) AS o_custkey, o_orderstatus, CAST(o_totalprice AS VARCHAR) AS o_totalprice,
  CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS o_orderdate, o_orderpriority, CAST(NULL AS VARCHAR) AS o_absent FROM orders"""
ORACLES["read_inferred"] = "SELECT CAST(c_custkey AS BIGINT) AS c_custkey, c_name, CAST(c_nationkey AS BIGINT) AS c_nationkey, c_acctbal, c_mktsegment FROM customer"
ORACLES["read_workbook"] = " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM {t}" for t in ("customer", "orders", "lineitem", "supplier"))
ORACLES["passthrough"] = "SELECT * FROM part"
ORACLES["reset_layers"] = (
    "SELECT 'orders' AS table_name, CAST(0 AS BIGINT) AS row_count, CAST(2 AS BIGINT) AS swept UNION ALL SELECT 'lineitem', 0, 2 "
    "UNION ALL SELECT 'customer', count(*), 0 FROM customer")
ORACLES["write_splits"] = " UNION ALL ".join(
    f"SELECT '{kind}/{e}' AS table_name, count(*) AS row_count, count(*) AS counted FROM {t}"
    for e in ("courses", "subjects", "students", "assessments", "grades", "attendance")
    for kind, t in (("processed", f"l_{e} WHERE error_reason IS NULL"), ("errors", f"l_{e} WHERE error_reason IS NOT NULL"),
                    ("corrections", f"({corrections('l_students', 'l_grades')}) WHERE entity = '{e}'")))
ORACLES["manifest"] = " UNION ALL ".join(
    f"SELECT '{t}.parquet' AS file, '{','.join(cs)}' AS columns, count(*) AS row_count, true AS digests_agree FROM {t}" for t, cs in TABLE_COLUMNS.items())
ORACLES["check_manifest"] = f"""
SELECT 'manifest' AS check_name, 'files' AS subject, count(*) AS violations
FROM (SELECT unnest({[*TABLES, "missing"]}) EXCEPT SELECT table_name FROM ({' UNION ALL '.join(f"SELECT '{t}' AS table_name, count(*) AS n FROM {t}" for t in TABLES)}))"""
ORACLES["name_fallback"] = "SELECT CAST(o_orderkey AS VARCHAR) AS assessment_id, o_orderstatus AS assessment_name, o_orderstatus AS assessment_type FROM orders"


def _counted(tables: dict[str, list[str]], workbook: str = "") -> str:
    """Cells of all columns: an empty text and a missing cell are nulls alike."""
    def one(t: str, c: str, width: int) -> str:
        v = f"nullif(trim(CAST({c} AS VARCHAR), ' ' || chr(9) || chr(10) || chr(13)), '')"
        shown = f"CASE WHEN {v} IS NOT NULL THEN CAST({c} AS VARCHAR) END"
        return (
            f"SELECT {workbook}'{t}' AS table_name, '{c}' AS column_name, count(*) AS total_rows, count(*) - count({v}) AS null_count, "
            f"count(DISTINCT {shown}) AS unique_count, count(DISTINCT {shown}) = count({v}) AND count({v}) > 0 AS is_unique, CAST({width} AS INTEGER) AS column_count FROM {t}")

    return " UNION ALL ".join(one(t, c, len(cs)) for t, cs in tables.items() for c in cs)


ORACLES["profile_tables"] = _counted(TABLE_COLUMNS)
ORACLES["profile_uploads"] = _counted({t: TABLE_COLUMNS[t] for t in PROFILED_UPLOADS})


def check(name: str, subject: str, violations: str) -> str:
    return f"SELECT '{name}' AS check_name, '{subject}' AS subject, CAST({violations} AS BIGINT) AS violations"


def _repeats(keys: str, t: str) -> str:
    return f"(SELECT count(*) FROM (SELECT {keys} FROM {t} GROUP BY ALL HAVING count(*) > 1))"


def _where(t: str, c: str) -> str:
    return f"(SELECT count(*) FROM {t} WHERE {c})"


ORACLES["check_keys"] = " UNION ALL ".join([
    check("unique", "grades", _repeats("grade_id", "c_grades")), check("unique", "grades_pair", _repeats("assessment_id, student_id", "c_grades")),
    check("unique", "lineitem", _repeats("l_orderkey, l_linenumber", "lineitem")),
    check("reference", "orders", _where("orders", "o_orderkey NOT IN (SELECT l_orderkey FROM lineitem)"))])
ORACLES["check_nulls"] = " UNION ALL ".join(
    check("not_null", f"{e}.{c}", _where(f"raw_{e}", f"{c} IS NULL"))
    for e, cs in (("grades", ["grade_id", "assessment_id", "student_id", "score"]), ("students", ["student_id", "first_name", "last_name", "gender"])) for c in cs)
ORACLES["check_ranges"] = " UNION ALL ".join([
    check("range", "grades.score", _where("c_grades", "score < 0.5 OR score > 5")),
    check("range", "assessments.weight_percentage", _where("c_assessments", "weight_percentage < 0 OR weight_percentage > 100")),
    check("range", "students.overall_average", _where("student_perf", "overall_average < 0 OR overall_average > 5"))])
ORACLES["check_tables"] = " UNION ALL ".join(check("not_empty", t, f"(SELECT CAST(count(*) = 0 AS BIGINT) FROM {t})") for t in TABLES)


def _bad_groups(keys: str, t: str) -> str:
    return f"(SELECT count(*) FROM (SELECT sum(weight_percentage) AS t FROM {t} GROUP BY {keys}) WHERE abs(t - 100) >= 0.5)"


ORACLES["check_weights"] = " UNION ALL ".join([
    check("weights", "clean", _bad_groups("subject_id, period_id", "c_assessments")), check("weights", "subject_only", _bad_groups("subject_id", "c_assessments")),
    check("weights", "staged", _bad_groups("subject_id, period_id", "st_assessments"))])
ORACLES["check_recompute"] = check("recompute", "final_grade", """(SELECT count(*) FROM final g JOIN (SELECT student_id, subject_id, period_id,
  round(sum(score * weight_percentage * CAST(0.01 AS DECIMAL(3,2))), 2) AS again FROM fact GROUP BY 1, 2, 3) r ON g.student_id = r.student_id
  AND coalesce(g.subject_id, '') = coalesce(r.subject_id, '') AND coalesce(g.period_id, '') = coalesce(r.period_id, '') WHERE abs(g.final_grade - r.again) > 0.01)""")
ORACLES["check_rates"] = " UNION ALL ".join([
    check("rates", "subjects", _where("subject_perf", "abs(pass_rate_percentage + fail_rate_percentage - 100) >= 0.05")),
    check("rates", "courses", _where("course_perf", "abs(overall_pass_rate_percentage + overall_fail_rate_percentage - 100) >= 0.05"))])
ORACLES["check_reasons"] = check("has_reason", "grades", _where("l_grades", "error_reason = ''"))
ORACLES["check_seeded"] = check("seeded", "grades", f"""(SELECT count(*) FROM (SELECT grade_id FROM raw_grades WHERE score = 'ND') a
  FULL JOIN (SELECT grade_id FROM raw_grades WHERE trim(score) <> '' AND NOT regexp_matches(score, {NUM})) b ON a.grade_id = b.grade_id
  WHERE a.grade_id IS NULL OR b.grade_id IS NULL)""")


# Dashboard measures
def measure_sql(by: list[str], where: str = "true") -> str:
    keys = ", ".join(by)
    slicers = "LEFT JOIN (SELECT course_id AS co, course_name, grade_level, academic_year FROM c_courses) ON course_id = co LEFT JOIN (SELECT subject_id AS su, subject_name, department FROM c_subjects) ON subject_id = su"
    fact = f"(SELECT * FROM fact {slicers} WHERE {where})"
    final = f"(SELECT * FROM (SELECT * EXCLUDE (course_name, subject_name, department) FROM final) {slicers} WHERE {where})"
    pre, group = (f"{keys}, ", f"GROUP BY {keys}") if by else ("", "")
    joined = "JOIN b ON " + " AND ".join(f"a.{k} IS NOT DISTINCT FROM b.{k}" for k in by) if by else "JOIN b ON true"
    names = "".join(f"a.{k}, " for k in by)
    return f"""
WITH a AS (SELECT {pre}count(*) AS total_grades, {avg2('score')} AS average_score, count(DISTINCT student_id) AS students_evaluated,
  CAST(sum(score * weight_percentage * CAST(0.01 AS DECIMAL(3,2))) AS DECIMAL(24,6)) AS weighted_final FROM {fact} {group}),
b AS (SELECT {pre}count(DISTINCT CASE WHEN is_approved THEN student_id END) AS students_approved, {avg2('final_grade')} AS average_final FROM {final} {group})
SELECT {names}total_grades, average_score, students_evaluated, weighted_final, students_approved, average_final,
  round(coalesce(students_approved / nullif(students_evaluated, 0), 0)::DOUBLE, 6) AS pass_rate,
  round(1 - coalesce(students_approved / nullif(students_evaluated, 0), 0)::DOUBLE, 6) AS fail_rate FROM a {joined}"""


ORACLES["measures_by_course"] = measure_sql(["course_id", "course_name"])
ORACLES["measures_by_department"] = measure_sql(["grade_level", "department"], "academic_year = 2026")
ORACLES["measures_overall"] = measure_sql([])
_SLICERS = {
    "course": ["course_id", "course_name"], "level": ["grade_level"], "subject": ["subject_id", "subject_name"], "department": ["department"],
    "level and department": ["grade_level", "department"], "year": ["academic_year"], "all": [],
}
_SLICED = {"course_id": "VARCHAR", "course_name": "VARCHAR", "grade_level": "INTEGER", "subject_id": "VARCHAR", "subject_name": "VARCHAR", "department": "VARCHAR", "academic_year": "INTEGER"}
_MEASURES = "total_grades, average_score, students_evaluated, weighted_final, students_approved, average_final, pass_rate, fail_rate"
ORACLES["measures_all_slicers"] = " UNION ALL ".join(
    f"SELECT '{n}' AS slicer, {', '.join(c if c in by else f'CAST(NULL AS {t}) AS {c}' for c, t in _SLICED.items())}, {_MEASURES} FROM ({measure_sql(by)})" for n, by in _SLICERS.items())
ORACLES["monthly_trend"] = f"""
SELECT d.year, d.month, count(score) AS total_grades, {avg2('score')} AS average_score FROM fact f JOIN dates d ON f.submission_date = d.date_key GROUP BY 1, 2"""
ORACLES["subject_spread"] = f"""
SELECT subject_id, subject_name, {avg2('final_grade')} AS average_final, round(stddev_samp(CAST(final_grade AS DOUBLE)), 6) AS std_final,
  count(DISTINCT CASE WHEN final_grade < 3.0 THEN student_id END) AS students_at_risk FROM final GROUP BY 1, 2"""
ORACLES["student_vs_course"] = f"""
SELECT f.student_id, f.course_id, f.subject_id, f.period_id, f.final_grade, a.course_average,
  CAST(f.final_grade - a.course_average AS DECIMAL(6,2)) AS difference
FROM final f JOIN (SELECT course_id, subject_id, {avg2('final_grade')} AS course_average FROM final GROUP BY 1, 2) a
ON f.course_id = a.course_id AND f.subject_id = a.subject_id"""
ORACLES["top_failing_subjects"] = "SELECT * FROM failures ORDER BY failure_rank, subject_id, course_name LIMIT 5"
ORACLES["describe_scores"] = """
SELECT count(score) AS count, round(avg(CAST(score AS DOUBLE)), 6) AS mean, round(stddev_samp(CAST(score AS DOUBLE)), 6) AS std,
  CAST(min(score) AS DOUBLE) AS min, round(quantile_cont(CAST(score AS DOUBLE), 0.25), 6) AS q25, round(quantile_cont(CAST(score AS DOUBLE), 0.5), 6) AS q50,
  round(quantile_cont(CAST(score AS DOUBLE), 0.75), 6) AS q75, CAST(max(score) AS DOUBLE) AS max FROM c_grades"""
ORACLES["run_layers"] = report_sql(
    _CHAIN, _FIXES,
    {"students": "st_students", "courses": "st_courses", "subjects": "st_subjects", "grades": "st_grades"},
).replace("SELECT *, coalesce(", "SELECT *, CAST(coalesce(").replace(", 0.00) AS rejection", ", 0.00) AS DECIMAL(5,2)) AS rejection")


def _needed(sql: str, found: dict[str, None]) -> None:
    for name in CTES:
        if name not in found and re.search(rf"\b{name}\b", sql):
            _needed(CTES[name], found)
            found[name] = None


def _complete(sql: str) -> str:
    """Puts the common tables a query mentions in front of it."""
    found: dict[str, None] = {}
    _needed(sql, found)
    if not found:
        return sql.strip()
    head = "WITH " + ", ".join(f"{n} AS ({CTES[n].strip()})" for n in found)
    body = sql.strip()
    return f"{head}, {body[5:]}" if body.upper().startswith("WITH ") else f"{head} {body}"


ORACLES = {name: _complete(sql) for name, sql in ORACLES.items()}
