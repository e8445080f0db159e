from pyspark.sql import functions as F

from scorelake.plans import validate
from scorelake.plans.schemas import COLUMNS



def as_of():
    return F.lit("2026-01-01").cast("date")


ORDER = ["_ord"]
STUDENT = "student_id document_number first_name gender birth_date course_id"


def reasons(labelled, key):
    return {r["_ord"]: r["error_reason"] for r in labelled.collect()} if key == "_ord" else {r[key]: r["error_reason"] for r in labelled.collect()}


def test_courses_and_subjects(frame):
    courses = frame("course_id course_name", [("1", "A"), ("nan", "B"), ("1", "C"), (None, "D"), (" ", "E")])
    assert reasons(validate.label_courses(courses, ORDER), "_ord") == {
        0: None, 1: "Null or empty course_id", 2: "Duplicate course_id primary key: 1", 3: "Null or empty course_id", 4: "Null or empty course_id"}
    subjects = frame("subject_id subject_name", [("1", " "), ("1", "B"), ("", "C"), ("2", "D"), ("2", "E")])
    assert reasons(validate.label_subjects(subjects, ORDER), "_ord") == {
        0: "Null or empty subject_name", 1: "Duplicate subject_id: 1", 2: "Null or empty subject_id", 3: None, 4: "Duplicate subject_id: 2"}


def test_students(frame):
    rows = [
        ("80", "1", "Sofía", "M", "2031-05-05", "4"), ("124", "2", "Mateo", "F", "1900-01-01", "7"), ("126", "3", "Felipe", "F", "2010-03-15", "77"),
        ("11", "4", "David", "M", "2014-04-03", "1"), ("11", "5", "David", "Masculino", "2014-04-03", "1"),
        ("101", "1007146672", "Ana", "F", "15/3/2010", "6"), ("102", "1007146672", "  JUAN ", "fem", "", " 6 "),
        ("103", "", "Leo", "otro", "31/02/2010", None), ("104", "", "Eva", None, None, None), (None, "9", "X", "M", None, None),
    ]
    courses = frame("course_id", [(c,) for c in "14678"])
    labelled = validate.label_students(frame(STUDENT, rows), ORDER, as_of(), courses)
    assert reasons(labelled, "_ord") == {
        0: "Impossible birth_date: '2031-05-05' (out of biological bounds)", 1: "Impossible birth_date: '1900-01-01' (out of biological bounds)",
        2: "curso_id inexistente (77)", 3: None, 4: "estudiante_id duplicado: 11", 5: None, 6: "documento duplicado: 1007146672",
        7: "Invalid birth_date format: '31/02/2010'", 8: None, 9: "Null or empty student_id"}
    s = validate.split(labelled, "students")
    log = {(r["id"], r["field"], r["original"], r["corrected"]) for r in s.corrections.collect()}
    assert log == {("11", "gender", "Masculino", "M"), ("102", "first_name", "  JUAN ", "JUAN"), ("102", "gender", "fem", "F")}
    assert s.valid.count() == 3 and s.errors.filter("student_id = '102'").first()["gender"] == "F"
    empty = courses.limit(0)
    off = validate.label_students(frame(STUDENT, rows), ORDER, as_of(), empty)
    assert reasons(off, "_ord")[2] is None


def test_assessments_by_group(frame):
    """38 groups of 4, two of which miss 100: 152 rows, 144 valid."""
    rows, n = [], 0
    for subject in range(1, 11):
        for period in range(1, 5 if subject <= 8 else 4):
            weights = {(3, 2): (5, 25, 30, 30), (5, 4): (15, 25, 30, 40)}.get((subject, period), (15, 25, 30, 30))
            for w in weights:
                n += 1
                rows.append((str(n), str(subject), str(period), f"T{n}", str(w)))
    labelled = validate.label_assessments(frame("assessment_id subject_id period_id assessment_name weight_percentage", rows), ORDER)
    s = validate.split(labelled, "assessments")
    assert (len(rows), s.valid.count(), s.errors.count()) == (152, 144, 8)
    assert {r["error_reason"] for r in s.errors.collect()} == {
        "pesos de evaluación del grupo ('3', '2') suman 90.0%, esperado 100%", "pesos de evaluación del grupo ('5', '4') suman 110.0%, esperado 100%"}


def test_assessment_row_rules(frame):
    rows = [("1", "S", None, "a", "60"), ("2", "S", None, "b", "40,0"), ("3", "S", None, "c", "150"), ("4", "S", None, "d", "-15"), ("5", "S", None, "e", "x"),
            ("6", "S", None, " ", "5"), ("7", "Z", None, "g", "5"), ("1", "S", None, "h", "5"), ("8", "T", None, "i", "0.4"), ("9", None, None, "j", "7"),
            ("10", "S", None, "k", None)]
    subjects = frame("subject_id", [("S",), ("T",)])
    labelled = validate.label_assessments(frame("assessment_id subject_id period_id assessment_name weight_percentage", rows), ORDER, subjects)
    got = reasons(labelled, "_ord")
    assert got == {
        0: None, 1: None, 2: "Weight percentage out of allowed range [0-100%]: 150.0", 3: "Weight percentage out of allowed range [0-100%]: -15.0",
        4: "Non-numeric weight percentage: 'x'", 5: "Null or empty assessment_name", 6: "Foreign key violation: subject_id 'Z' does not exist",
        7: "Duplicate assessment_id: 1", 8: "pesos de evaluación del grupo T suman 0.4%, esperado 100%", 9: None, 10: "Non-numeric weight percentage: 'nan'"}


def test_grades(frame):
    rows = [
        ("g0", "A", "1", "4,5", "2025-01-01"), ("g1", "A", "1", "4,5", "2025-01-01"), ("g2", "A", "2", "6.8", None), ("g3", "A", "2", "-1.5", None),
        ("g4", "A", "2", None, None), ("g5", "A", "2", "ND", None), ("g6", "A", "EST-999", "3", None), ("g7", "NOPE", "1", "3", None),
        ("g8", "A", "1", "3", "2026-99-99"), ("g9", "A", "1", "3", "2999-01-01"), ("g10", "A", "1", "3", "31/12/2025"), ("g11", "A", None, "3", None),
        ("g12", "A", "2", "7,2", None),
    ]
    students, assessments = frame("student_id", [(" 1 ",), ("2",)]), frame("assessment_id", [("A",)])
    labelled = validate.label_grades(frame("grade_id assessment_id student_id score submission_date", rows), ORDER, as_of(), students, assessments)
    assert reasons(labelled, "grade_id") == {
        "g0": None, "g1": "fila duplicada", "g2": "nota fuera de rango (6.8)", "g3": "nota fuera de rango (-1.5)", "g4": "nota nula",
        "g5": "nota no numérica ('ND')", "g6": "estudiante_id inexistente (EST-999)", "g7": "evaluacion_id inexistente (NOPE)",
        "g8": "fecha inválida (texto '2026-99-99')", "g9": "fecha futura (2999-01-01)", "g10": None, "g11": "estudiante_id inexistente (nan)",
        "g12": "nota fuera de rango (7.2)"}
    s = validate.split(labelled, "grades")
    assert {(r["grade_id"], r["score"]) for r in s.valid.collect()} == {("g0", "4.5"), ("g10", "3")}
    assert {r["id"]: r["reason"] for r in s.corrections.collect()} == {
        "g0": "Conversión de decimal con coma '4,5' a formato punto '4.5'", "g12": "Conversión de decimal con coma '7,2' a formato punto '7.2'"}
    assert s.errors.filter("grade_id = 'g12'").first()["score"] == "7,2"


def test_attendance(frame):
    rows = [("1", "s", "50", "-2"), ("2", "s", "45", "50"), ("3", "s", "45.9", "45.2"), ("4", "s", "x", "1"), ("5", " ", "9", "1"), ("6", "s", "9", None), ("7", "s", "9", "-0.5")]
    assert reasons(validate.label_attendance(frame("attendance_id student_id total_classes absences", rows)), "attendance_id") == {
        "1": "inasistencias negativas", "2": "inasistencias > días de clase", "3": None, "4": "Valores de asistencia no enteros",
        "5": "Null or empty student_id", "6": "Valores de asistencia no enteros", "7": None}


def test_required_and_sample(frame):
    df = frame("grade_id score", [("1", None), ("2", "nan")])
    got = {r["column_name"]: (r["present"], r["blank_count"]) for r in validate.check_required(df, ["grade_id", "score", "student_id"], "grades").collect()}
    assert got == {"grade_id": (True, 0), "score": (True, 2), "student_id": (False, None)}
    errors = df.withColumn("error_reason", F.lit("x"))
    sample = validate.error_sample(errors, "grades", 1, ["grade_id"]).collect()
    assert [(r["error_total"], r["grade_id"], r["score"]) for r in sample] == [(2, "1", "")]


def test_summary_of_a_whole_run(frame):
    tables = {
        "courses": frame("course_id course_name", [("1", "A"), ("1", "B")]),
        "students": frame(STUDENT, [("s1", None, "A", "M", None, "1"), ("s2", None, "B", "M", None, "9")]),
        "assessments": frame(" ".join(COLUMNS["assessments"]), [("a", None, "m", "1", "T", None, "100", None, None)]),
        "grades": frame(" ".join(COLUMNS["grades"]), [("g", "a", "s1", "3", None, None, None), ("h", "a", "s2", "3", None, None, None)]),
    }
    done = validate.validate_all(tables, {}, as_of())
    got = {r["entity"]: (r["total"], r["valid"], r["errors"]) for r in validate.summary(done).collect()}
    assert got == {"courses": (2, 1, 1), "students": (2, 1, 1), "assessments": (1, 1, 0), "grades": (2, 1, 1)}
    assert done["grades"].errors.first()["error_reason"] == "estudiante_id inexistente (s2)"
