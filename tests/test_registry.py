import pytest

from millrace import compile_routes, registry_from_csv, registry_from_format, registry_from_frames, registry_from_tables
from millrace.operators.project import FieldPlan
from millrace.plans.registry import routes_of, target_name, undefined_structures

ROUTES = """IDENTIFICADOR;ESTRUCTURA;PATH_CLASIFICADOR;BASE_DATOS;TABLA;ESTADO
app;S1;p.gate&north side;yard;arrivals;Activo
app;S2;p.gate&north side;yard;notes;Activo
app;S1;SELECT * FROM DataIN WHERE p.size > 3 OR "q" = 'a;Inactivo
other;S9;p.gate&x;yard;lost;Activo
""".replace("'a;Inactivo", "'a';yard;arrivals;Inactivo")
FIELDS = """p.b;beta;String;S1
p.a;alpha;Integer;S1
p.c[0];user-agent;;S1
p.z;zeta;Bigint;S2
"""


@pytest.fixture()
def files(tmp_path):
    (tmp_path / "routes.csv").write_text(ROUTES)
    (tmp_path / "fields.csv").write_text(FIELDS)
    return str(tmp_path / "routes.csv"), str(tmp_path / "fields.csv")


@pytest.fixture()
def registry(spark, files):
    return registry_from_csv(spark, *files)


def test_compile(registry):
    plans = compile_routes(registry, "app")
    assert [(p.route_id, p.structure, p.target) for p in plans] == [
        ("app_001_arrivals", "S1", "yard.arrivals"), ("app_002_notes", "S2", "yard.notes"), ("app_003_arrivals", "S1", "yard.arrivals")]
    assert plans[0].fields == (
        FieldPlan("p.b", "beta", "String"), FieldPlan("p.a", "alpha", "Integer"), FieldPlan("p.c[0]", "user-agent", None))
    assert plans[2].predicate == "SELECT * FROM DataIN WHERE p.size > 3 OR \"q\" = 'a'"


def test_status_only_on_request(registry):
    assert routes_of(registry, "app").count() == 3
    assert len(compile_routes(registry, "app", active_only=True)) == 2


def test_refusals(spark, registry):
    assert [r["structure"] for r in undefined_structures(registry).collect()] == ["S9"]
    with pytest.raises(ValueError, match="S9"):
        compile_routes(registry, "other")
    assert compile_routes(registry, "other", skip_undefined=True) == ()
    with pytest.raises(ValueError, match="no route"):
        compile_routes(registry, "nobody")
    twice = registry_from_frames(
        registry.routes, registry.fields.union(registry.fields.replace("p.b", "p.x", "path")))
    with pytest.raises(ValueError, match="twice"):
        compile_routes(twice, "app")
    with pytest.raises(ValueError, match="not a path"):
        compile_routes(registry_from_frames(registry.routes, registry.fields.replace("p.b", "p..b", "path")), "app")
    with pytest.raises(ValueError, match="lacks"):
        registry_from_frames(registry.routes.drop("db"), registry.fields)


def test_cells_are_taken_as_written(spark):
    routes = spark.createDataFrame(
        [("app", "S", "p.k& two blanks ", "d", "t", None, 1)],
        "identifier string, structure string, predicate string, db string, `table` string, status string, ord int")
    fields = spark.createDataFrame([("p.k", "k", None, "S")], "path string, name string, type string, structure string")
    (only,) = compile_routes(registry_from_frames(routes, fields), "app")
    assert only.predicate == "p.k& two blanks " and only.fields[0].type is None


def test_leading_key_column(spark, tmp_path, registry):
    (tmp_path / "r.csv").write_text("".join(f"{i};{line}\n" for i, line in enumerate(ROUTES.splitlines()[1:])))
    (tmp_path / "f.csv").write_text("".join(f"{i};{line}\n" for i, line in enumerate(FIELDS.splitlines())))
    keyed = registry_from_csv(
        spark, str(tmp_path / "r.csv"), str(tmp_path / "f.csv"), routes_header=False, leading_key=True)
    assert compile_routes(keyed, "app") == compile_routes(registry, "app")


def test_tables_and_formats(spark, tmp_path, registry):
    registry.routes.createOrReplaceTempView("t_routes")
    registry.fields.withColumnRenamed("path", "json_path").createOrReplaceTempView("t_fields")
    named = registry_from_tables(spark, "t_routes", "t_fields", field_names={"json_path": "path"})
    registry.routes.write.json(str(tmp_path / "r"))
    registry.fields.write.json(str(tmp_path / "f"))
    loaded = registry_from_format(spark, "json", {"path": str(tmp_path / "r")}, {"path": str(tmp_path / "f")})
    assert compile_routes(named, "app") == compile_routes(loaded, "app") == compile_routes(registry, "app")


def test_target_name():
    assert target_name("yard", "in") == "yard.in"
    assert target_name("yard", "in", "impala::{db}.{table}") == "impala::yard.in"
