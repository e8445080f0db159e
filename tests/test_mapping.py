import pytest
from pyspark.sql import functions as F

from scorelake.plans import mapping, profile
from scorelake.plans.schemas import FIELD_WORDS, TABLE_WORDS


@pytest.fixture
def sheet(spark):
    def make(columns: str, rows: list[tuple] | None = None):
        names = columns.split()
        return spark.createDataFrame(rows or [], ", ".join(f"`{n}` string" for n in names))

    return make


def test_full_workbook_confidences(spark, sheet):
    tables = {
        "diccionario": sheet("hoja campo"),
        "estudiantes": sheet("estudiante_id documento nombres apellidos genero fecha_nacimiento curso_id estado"),
        "materias": sheet("materia_id nombre_materia"),
        "curso_materia": sheet("curso_materia_id curso_id materia_id docente_id intensidad_horaria"),
        "evaluaciones": sheet("evaluacion_id materia_id periodo_id tipo porcentaje fecha_evaluacion"),
        "notas": sheet("nota_id estudiante_id evaluacion_id nota fecha_registro"),
        "asistencia": sheet("asistencia_id estudiante_id periodo_id dias_clase inasistencias excusas"),
        "periodos": sheet("periodo_id nombre fecha_inicio fecha_fin peso_pct anio"),
        "cursos": sheet("curso_id nombre_curso grado"),
        "docentes": sheet("docente_id nombre"),
        "escala_desempeno": sheet("nivel nota_min nota_max"),
        "errores_sembrados": sheet("hoja id problema"),
    }
    got = {r["table_name"]: r for r in mapping.proposal(mapping.build_catalog(spark, {"w": tables})).collect()}
    assert {t: (r["entity"], r["confidence"]) for t, r in got.items()} == {
        "estudiantes": ("students", 1.0), "materias": ("subjects", 1.0), "curso_materia": ("course_subjects", 1.0), "evaluaciones": ("assessments", 1.0),
        "notas": ("grades", 1.0), "asistencia": ("attendance", 0.93), "periodos": ("periods", 0.92), "cursos": ("courses", 0.87),
        "docentes": ("teachers", 0.71), "escala_desempeno": ("performance_scale", 0.7)}
    assert got["cursos"]["column_mapping"] == {"curso_id": "course_id", "nombre_curso": "course_name", "grado": "level"}
    assert got["cursos"]["field_confidences"] == {"course_id": 1.0, "course_name": 1.0, "level": 0.7}
    assert got["periodos"]["column_mapping"] == {
        "periodo_id": "period_id", "fecha_inicio": "start_date", "fecha_fin": "end_date", "nombre": "period_name", "peso_pct": "weight"}
    assert got["estudiantes"]["column_mapping"]["documento"] == "document_number" and got["estudiantes"]["ignored_column_count"] == 1
    assert got["estudiantes"]["field_confidences"]["first_name"] == 0.95
    assert got["docentes"]["column_mapping"] == {"docente_id": "teacher_id", "nombre": "first_name"}
    assert got["asistencia"]["ignored_column_count"] == 1


def test_synonyms_in_any_order(spark, sheet):
    tables = {
        "alumnos": sheet("email_estudiante apellido nombre codigo_alumno", [("a@x", "Pérez", "Juan", "ALU-01")]),
        "actividades": sheet("porcentaje actividad id_actividad", [("40.0", "Taller 1", "ACT-1"), ("60", "Final", "ACT-2")]),
        "registro_notas": sheet("resultado id_actividad codigo_alumno", [("4,5", "ACT-1", "ALU-01")]),
    }
    p = mapping.propose_mapping(tables)
    assert p.can_process and set(p.mapping) == {"students", "assessments", "grades"}
    student = mapping.apply_mapping(tables["alumnos"], p.mapping["students"][1], "students").first().asDict()
    assert {k: v for k, v in student.items() if v} == {"student_id": "ALU-01", "first_name": "Juan", "last_name": "Pérez", "email": "a@x"}
    # Its grade columns carry words no key field knows, so applying it stops.
    assert p.mapping["grades"][1]["resultado"] == "score"
    assert mapping.missing_fields(p.mapping) == ["grades: student_id", "grades: assessment_id"]


def test_minimal_workbook_invents_nothing(sheet):
    tables = {
        "estudiantes": sheet("estudiante_id nombre", [("E1", "Lucas"), ("E2", "Elena")]),
        "evaluaciones": sheet("evaluacion_id nombre peso", [("EV1", "Quiz", "50"), ("EV2", "Parcial", "50")]),
        "notas": sheet("estudiante_id evaluacion_id nota", [("E1", "EV1", "4.0"), ("E2", "EV2", "4.5")]),
    }
    p = mapping.propose_mapping(tables)
    assert p.can_process and len(p.warnings) == 2
    assert p.scale.first().asDict() == {"scale_type": "0-5", "min_grade": 0.0, "max_grade": 5.0, "passing_grade": 3.0}
    assert tuple(p.weight_rule.first()) == ("by_subject_period", "subject_id,period_id", 0)
    raw = mapping.apply_proposal(tables, p.mapping)
    assert {e: raw[e].count() for e in ("students", "assessments", "grades", "courses")} == {"students": 2, "assessments": 2, "grades": 2, "courses": 0}
    assert raw["students"].filter("email <> '' or course_id <> ''").isEmpty()
    assert {r["grade_id"] for r in raw["grades"].collect()} == {"G-000001", "G-000002"}


def test_missing_mandatory_field_is_an_error(sheet):
    with pytest.raises(ValueError, match="grades: score"):
        mapping.apply_proposal({"n": sheet("a b")}, {"grades": ("n", {"a": "student_id", "b": "assessment_id"})})


def test_name_fallback_type_then_id(sheet):
    typed = mapping.apply_mapping(sheet("i t w", [("1", "Quiz", "10"), ("2", None, "20")]), {"i": "assessment_id", "t": "type", "w": "weight"}, "assessments")
    assert [r["assessment_name"] for r in typed.orderBy("assessment_id").collect()] == ["Quiz", None]
    bare = mapping.apply_mapping(sheet("i w", [("1", "10")]), {"i": "assessment_id", "w": "weight"}, "assessments")
    assert bare.first()["assessment_name"] == "1"


def test_unplaced_fields_and_dates(sheet):
    df = sheet("c n l x", [("1", "6A", "alto", None), ("2", "6B", None, "z")])
    out = mapping.apply_mapping(df, {"c": "course_id", "n": "course_name", "l": "level"}, "courses")
    assert [r["extra"] for r in out.orderBy("course_id").collect()] == ['{"l":"alto"}', '{"x":"z"}']
    born = mapping.apply_mapping(sheet("s f", [("1", "3/2/2010")]), {"s": "student_id", "f": "birth_date"}, "students")
    assert born.first()["birth_date"] == "2010-02-03"


def test_scale_from_table_and_from_scores(sheet):
    scale = sheet("level min_score max_score", [("Bajo", "0", "2,9"), ("Básico", "3.0", "3.9"), ("Superior", "4.6", "5.0")])
    assert mapping.detect_scale(scale, None).first().asDict() == {"scale_type": "0-5", "min_grade": 0.0, "max_grade": 5.0, "passing_grade": 3.0}
    unnamed = sheet("level min_score max_score", [("A", "0", "60"), ("B", "61", "80"), ("C", "81", "100")])
    assert mapping.detect_scale(unnamed, None).first()["passing_grade"] == 61.0
    scores = sheet("score", [("8,5",), ("9",), ("ND",)])
    assert mapping.detect_scale(None, scores).first()["scale_type"] == "0-10"
    assert mapping.detect_scale(None, sheet("score", [("77",)])).first()["max_grade"] == 100.0
    assert mapping.detect_scale(None, None).first()["scale_type"] == "0-5"


def test_weight_rule(sheet):
    rows = [("m1", "p1", "60"), ("m1", "p1", "40"), ("m2", "p1", "1,0"), ("m3", "p2", "90"), (None, "p9", "5")]
    got = mapping.detect_weight_rule(sheet("subject_id period_id weight", rows)).first()
    assert (got["rule"], got["group_cols"], float(got["valid_group_ratio"])) == ("by_subject_period", "subject_id,period_id", 0.6667)
    assert mapping.detect_weight_rule(sheet("subject_id", [("m",)])).first()["rule"] == "none"
    assert mapping.detect_weight_rule(sheet("subject_id weight", [("m", "7")])).first()["rule"] == "by_subject_period"
    assert mapping.detect_weight_rule(sheet("period_id weight", [("m", "100")])).first()["rule"] == "by_period"


def test_ignored_tables_and_columns(spark, sheet):
    catalog = mapping.build_catalog(spark, {"w": {"notas": sheet("nota zzz"), "glosario": sheet("a")}})
    assigned = mapping.assign_entities(mapping.score_tables(catalog))
    assert [r["table_name"] for r in mapping.ignored_tables(catalog, assigned).collect()] == ["glosario"]
    assert [r["column_name"] for r in mapping.ignored_columns(catalog, mapping.map_columns(catalog, assigned)).collect()] == ["zzz"]


def test_words_cover_every_entity():
    assert set(FIELD_WORDS) == set(TABLE_WORDS)


def test_profile_types(spark):
    rows = [("1", "1,5", "2025-01-02", "a", None, True), ("2", "2.5", "03/02/2025", "b", " ", False), ("3", "x", "2025/1/4", "a", "nan", True),
            ("4", "3", "bad", "c", None, True), ("5", "4", "2025-01-06", "d", None, None)]
    df = spark.createDataFrame(rows, "i string, f string, d string, s string, e string, b boolean")
    got = {r["column_name"]: r for r in profile.profile_columns(df, "t").collect()}
    assert {c: r["inferred_type"] for c, r in got.items()} == {"i": "integer", "f": "float", "d": "date", "s": "string", "e": "empty", "b": "boolean"}
    assert got["f"]["has_comma_floats"] and (got["f"]["min_number"], got["f"]["max_number"]) == (1.5, 4.0)
    assert str(got["d"]["min_date"]) == "2025-01-02" and str(got["d"]["max_date"]) == "2025-03-02"
    assert got["i"]["is_unique"] and not got["s"]["is_unique"] and got["s"]["sample_values"] == ["a", "b", "c", "d"]
    assert (got["e"]["null_count"], float(got["e"]["null_percentage"]), got["e"]["unique_count"]) == (5, 100.0, 0)
    empty = {r["column_name"]: r["inferred_type"] for r in profile.profile_columns(df.limit(0), "t").collect()}
    assert set(empty.values()) == {"empty"} and len(empty) == 6


def test_dictionary_counts_null_as_a_value(spark):
    df = spark.createDataFrame([("a", 1.5), ("a", None), (None, 3.0)], "k string, v double")
    got = {r["column_name"]: r for r in profile.data_dictionary(df, "t").collect()}
    assert (got["k"]["unique_count"], got["k"]["null_count"], got["k"]["duplicate_keys"], got["k"]["sample_value"]) == (2, 1, 1, "a")
    assert (got["v"]["dtype"], got["v"]["min_number"], got["v"]["max_number"], got["v"]["unique_count"]) == ("double", 1.5, 3.0, 3)


def test_describe(spark):
    df = spark.createDataFrame([(float(i),) for i in range(1, 5)], "v double")
    r = profile.describe_column(df, "v").first()
    assert (r["count"], r["mean"], r["min"], r["q25"], r["q50"], r["q75"], r["max"]) == (4, 2.5, 1.0, 1.75, 2.5, 3.25, 4.0)
    assert r["std"] == pytest.approx(1.2909944487)
