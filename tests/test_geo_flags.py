"""Department lookup (last match wins, groups, defaults) and multi-flags."""

from recaudo.operators import flags, geo


PATTERNS = [
    (1, "CALI", "VALLE DEL CAUCA", 1),
    (2, "CALIMA", "VALLE DEL CAUCA", 1),
    (3, "SAN PEDRO", "ANTIOQUIA", 1),
    (4, "SAN", "SANTANDER", 1),           # later, shorter: wins over SAN PEDRO
    (5, "ARMENIA", "ANTIOQUIA", 1),
    (6, "PASTO", "NO ES DEPARTAMENTO", 1),
    (1, "PASTO", "NARINO", 2),
    (2, "BOGOTA", "CUNDINAMARCA", 2),
]


def test_department_resolution(spark):
    cities = ["Cali", "Bogota/D.C.", "san pedro de uraba", "PASTO", "", None, "Atlantida", "META",
              "armenia/quindio", "/x"]
    df = spark.createDataFrame([(i, c) for i, c in enumerate(cities)], "id int, ciudad string")
    pats = geo.pattern_table(spark, PATTERNS)
    out = {r.id: (r.c, r.departamento) for r in
           geo.resolve_departments(df, "ciudad", pats, out_city="c").collect()}
    assert out[0] == ("CALI", "VALLE DEL CAUCA")
    assert out[1] == ("BOGOTA", "CUNDINAMARCA")
    assert out[2] == ("SAN PEDRO DE URABA", "SANTANDER")
    assert out[3] == ("PASTO", "NARINO")              # group-1 hit is not a department -> group 2
    assert out[4] == ("VACIO", "VACIO") and out[5] == ("VACIO", "VACIO")
    assert out[6] == ("ATLANTIDA", "NO IDENTIFICADO")
    assert out[7] == ("META", "META")                 # the city itself is a department name
    assert out[8] == ("ARMENIA", "ANTIOQUIA")
    assert out[9] == ("", "NO IDENTIFICADO")


def test_multi_flags_null_and_empty_documents(spark):
    rows = [("a1", "100", "RR", "Churn"), ("a2", "100", "BSCS", "Churn"), ("a3", "200", "RR", "Churn"),
            ("a4", "200", "RR", "Potencial"), ("a5", None, "RR", "x"), ("a6", None, "SGA", "y"),
            ("a7", "", "RR", "x"), ("a8", "", "BSCS", "y"), ("a9", "300", "RR", None)]
    df = spark.createDataFrame(rows, "cuenta string, doc string, crm string, marca string")
    out = {r.cuenta: (r.multicuenta, r.multiproducto, r.multimora) for r in
           flags.multi_flags(df, "doc", "cuenta", {"multiproducto": "crm", "multimora": "marca"}).collect()}
    assert out["a1"] == ("Aplica", "Aplica", "No aplica")
    assert out["a3"] == ("Aplica", "No aplica", "Aplica")
    for k in ("a5", "a6", "a7", "a8"):                  # NULL and '' documents never group
        assert out[k] == ("No aplica", "No aplica", "No aplica")
    assert out["a9"] == ("No aplica", "No aplica", "No aplica")
    assert len(out) == 9


def test_list_flag_no_fanout(spark):
    base = spark.createDataFrame([("1",), ("2",), ("3",)], "k string")
    lst = spark.createDataFrame([("1",), ("1",), (None,), ("9",)], "k string")
    out = {r.k: r.f for r in flags.list_flag(base, lst, ["k"], "f").collect()}
    assert out == {"1": "APLICA", "2": None, "3": None}


def test_multi_flags_numeric_document(spark):
    rows = [(1, 10, "RR"), (2, 10, "SGA"), (3, None, "RR"), (4, 20, "RR")]
    df = spark.createDataFrame(rows, "cuenta bigint, doc bigint, crm string")
    out = {r.cuenta: (r.multicuenta, r.multiproducto) for r in
           flags.multi_flags(df, "doc", "cuenta", {"multiproducto": "crm"}).collect()}
    assert out == {1: ("Aplica", "Aplica"), 2: ("Aplica", "Aplica"), 3: ("No aplica", "No aplica"),
                   4: ("No aplica", "No aplica")}


def test_department_of_known_cities(spark):
    # later entries of a group win, as in the reports: the names that decide the order
    rows = [(1, "BOGOTA", "CUNDINAMARCA", 2), (1, "ARMENIA", "QUINDIO", 1), (2, "ARMENIA", "ANTIOQUIA", 1),
            (3, "CUCUTA", "N. DE SANTANDER", 1), (4, "CUCUTA", "SANTANDER", 1), (5, "CALI", "VALLE", 1), (2, "CALI", "VALLE DEL CAUCA", 2)]
    cities = [("Bogota/DC", "CUNDINAMARCA"), ("armenia", "ANTIOQUIA"), ("CUCUTA NORTE", "SANTANDER"), ("Cali", "VALLE DEL CAUCA"),
              (None, "VACIO"), ("", "VACIO"), ("Antioquia", "ANTIOQUIA"), ("Lejos", "NO IDENTIFICADO")]
    df = spark.createDataFrame([(c,) for c, _ in cities], "c string")
    got = {r.c: r.departamento for r in geo.resolve_departments(df, "c", geo.pattern_table(spark, rows)).collect()}
    assert got == dict(cities)


def test_unidentified_cities_and_unparsable_dates(spark):
    from recaudo.operators import profile
    df = spark.createDataFrame([("Lejos", "31/02/2025"), ("Lejos", "1/4/2025"), (None, " "), ("Cali", "raro")], "c string, f string")
    pats = geo.pattern_table(spark, [(1, "CALI", "VALLE DEL CAUCA", 1)])
    assert [tuple(r) for r in profile.unidentified_cities(df, "c", pats).collect()] == [("Lejos", 2)]
    assert sorted(tuple(r) for r in profile.unparsable_dates(df, "f").collect()) == [("31/02/2025", 1), ("raro", 1)]


# ------------------------------------------------------------ the dictionary's real size and order

def by_definition(city, patterns):
    """Last matching entry of each group, as the rule is written down."""
    from recaudo.functions import fixed
    found = {}
    for _, pattern, dept, grp in sorted(patterns):
        if pattern in city:
            found[grp] = dept
    for d in (found.get(1, city), found.get(2, city)):
        if d in fixed.DEPARTMENTS:
            return d
    return "NO IDENTIFICADO"


def large_dictionary(rng):
    """1,100 patterns over few letters, so that many contain one another."""
    from recaudo.functions import fixed
    departments = [*sorted(fixed.DEPARTMENTS), "SIN NOMBRE"]
    rows, seen = [], set()
    while len(rows) < 1100:
        p = "".join(rng.choice("ABE ") for _ in range(rng.choice([1, 2, 3, 4, 5, 6, 8, 12])))
        if p not in seen:
            seen.add(p)
            rows.append((len(rows) + 1, p, rng.choice(departments), rng.choice([1, 2])))
    return rows


def test_large_dictionary_against_its_definition(spark, tmp_path):
    import random
    rng = random.Random(4)
    rows = large_dictionary(rng)
    cities = {("".join(rng.choice("ABEX ") for _ in range(rng.randint(1, 14)))) for _ in range(400)} | {"A", "AB", "ABEABEABEABE", "X"}
    df = spark.createDataFrame([(c,) for c in cities], "c string")
    want = {c: by_definition(c, rows) for c in cities}
    from_rows = geo.pattern_table(spark, rows)
    path = tmp_path / "dictionary.csv"
    path.write_text("ord;pattern;department;grp\n" + "".join(f'{o};"{p}";{d};{g}\n' for o, p, d, g in rows), encoding="utf-8")
    from_file = geo.read_pattern_table(spark, str(path))
    for patterns in (from_rows, geo.PatternDictionary(from_rows.df)):
        assert {r.c: r.departamento for r in geo.resolve_departments(df, "c", patterns).collect()} == want
    assert from_file.gram_sizes == from_rows.gram_sizes == [1, 2, 3]
    hits = geo.pattern_hits(df, "c", from_rows).groupBy("_city").count().collect()
    assert {r._city: r["count"] for r in hits} == {c: n for c in cities if (n := sum(p in c for _, p, _, _ in rows))}


def test_every_pattern_has_one_entry_the_rarest(spark):
    rows = [(k, f"MUNICIPIO DE {c}{c}{c}", "META", 1) for k, c in enumerate("ABCDEFGH")] + [(9, "X", "META", 2), (10, "YZ", "META", 2)]
    index = {r.pattern: r.gram for r in geo.pattern_table(spark, rows).index().collect()}
    assert len(index) == len(rows) and index["X"] == "X" and index["YZ"] == "YZ"
    assert all(index[f"MUNICIPIO DE {c}{c}{c}"] in (f"E {c}", f" {c}{c}", f"{c}{c}{c}") for c in "ABCDEFGH")


def test_probes_are_the_only_rows_made_of_texts(spark):
    from recaudo.plans.q_consolidation import pattern_index_lookup
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = pattern_index_lookup(spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert plan.count("Generate explode") == 3                    # the texts' probes, and the patterns' entries (counted, and chosen)
    assert "NestedLoop" not in plan and "Cartesian" not in plan
    assert "gram" in plan and "Contains(" in plan


def test_expected_departments_of_known_cities(spark):
    """The reports' own answers; some are odd because a later list names the city again."""
    rows = [(1, "CUCUTA", "SANTANDER", 1), (2, "SAN PEDRO", "SUCRE", 1), (3, "FLORENCIA", "CAQUETA", 1), (4, "ARMENIA", "QUINDIO", 1), (5, "ARMENIA", "ANTIOQUIA", 1),
            (6, "SAN PEDRO", "ANTIOQUIA", 1), (1, "CARTAGENA", "BOLIVAR", 2), (2, "BOGOTA", "CUNDINAMARCA", 2), (3, "PASTO", "NARINO", 2), (4, "CALI", "VALLE DEL CAUCA", 2)]
    want = {"BOGOTA": "CUNDINAMARCA", "CARTAGENA": "BOLIVAR", "CALI": "VALLE DEL CAUCA", "PASTO": "NARINO", "FLORENCIA": "CAQUETA", "CUCUTA": "SANTANDER",
            "SAN PEDRO": "ANTIOQUIA", "ARMENIA": "ANTIOQUIA"}
    df = spark.createDataFrame([(c,) for c in want], "c string")
    assert {r.c: r.departamento for r in geo.resolve_departments(df, "c", geo.pattern_table(spark, rows)).collect()} == want
