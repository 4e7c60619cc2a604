import pytest

from clipforge.operators.units import unit_members, unit_queries
from clipforge.sources.persons_export import read_persons_export, resolve_layout


def test_layouts_and_queries(spark, tmp_path):
    p = tmp_path / "q.csv"
    p.write_text("Name,Organisations > Organisational unit-0,Alle organisational units\n"
                 "A. Jansen,,Universiteit // Faculteit Geo // Dept X\n"
                 "B. de Vries,Faculteit Beta,\n"
                 "C. Klein,Dept Y,\n"
                 "A. Jansen,Faculteit Geo,\n"
                 "D. Smit,Faculteit // X,\n")
    ex = resolve_layout(read_persons_export(spark, str(p)))
    m = unit_members(ex)
    got = sorted((r.faculty, r.name_variant) for r in m.collect())
    assert got == [("Faculteit // X", "D. Smit"), ("Faculteit Beta", "B. de Vries"),
                   ("Faculteit Geo", "A. Jansen"), ("Faculteit Geo", "A. Jansen")]
    q = {r.faculty: r.query for r in unit_queries(m, limit=1).collect()}
    assert q["Faculteit Geo"] == '("Utrecht University" OR "Universiteit Utrecht") NEAR/50 ("A. Jansen")'


def test_unknown_layout(spark, tmp_path):
    p = tmp_path / "bad.csv"
    p.write_text("x,y\n1,2\n")
    with pytest.raises(ValueError):
        resolve_layout(read_persons_export(spark, str(p)))


def test_chunks(spark):
    rows = [("Faculteit A", f"n{i % 37}", i) for i in range(200)]
    m = spark.createDataFrame(rows, "faculty string, name_variant string, row_pos long")
    q = unit_queries(m, limit=10).collect()
    assert sum(r.n_names for r in q) == 37 and max(r.n_names for r in q) <= 10
    first = min(q, key=lambda r: r.chunk)
    assert first.query.endswith('("n0" OR "n1" OR "n2" OR "n3" OR "n4" OR "n5" OR "n6" OR "n7" OR "n8" OR "n9")')
