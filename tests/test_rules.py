"""Domain rules on small literal fixtures (schemas the reference reads)."""

from decimal import Decimal

from recaudo.functions import bands, classify, dates, fixed, keys, text
from recaudo.operators import outcomes


def test_brand_rules_first_match_and_refinement(spark):
    data = [
        # m5, m6, m7, m43, crm, campaign, age, expected
        ("Y", "N", "N", "N", "BSCS", "x", "30", "Potencial"),
        ("Y", "N", "N", "N", "RR", "x", "30", "Churn"),
        ("Y", "N", "N", "N", "SGA", "x", "30", "Churn"),
        ("Y", "N", "N", "N", "ASCARD", "x", "30", "Provision"),
        ("N", "Y", "N", "N", "BSCS", "x", "30", "Prepotencial"),
        ("N", "Y", "N", "N", "BSCS", "PrePotencial Convergente Masivo_2", "30", "Prepotencial Especial"),
        ("N", "Y", "N", "N", "BSCS", "PrePotencial Convergente Pyme_2", "30", "Prepotencial Especial"),
        ("N", "Y", "N", "N", "RR", "PrePotencial Convergente Pyme_2", "30", "Prechurn"),
        ("N", "Y", "N", "N", "ASCARD", "x", "30", "Preprovision"),
        ("N", "N", "Y", "N", "BSCS", "x", "30", "Castigo"),
        ("N", "N", "N", "Y", "BSCS", "x", "30", "Potencial a Castigar"),
        ("N", "N", "N", "N", "BSCS", "x", "120", "120 - 180"),
        ("N", "N", "N", "N", "BSCS", "x", "150", "120 - 180"),
        ("N", "N", "N", "N", "BSCS", "x", "180", "120 - 180"),
        ("N", "N", "N", "N", "BSCS", "x", "210", "210"),
        # a NULL mark makes its rule NULL: falls through to the next rule
        (None, "Y", "N", "N", "BSCS", "x", "30", "Prepotencial"),
        (None, None, None, "Y", "BSCS", "x", "60", "60"),
        ("Y", "N", "N", "N", None, "x", "90", "90"),
    ]
    df = spark.createDataFrame(data, "m5 string, m6 string, m7 string, m43 string, crm string, "
                                     "campaign string, age string, expected string")
    out = df.select(classify.brand("m5", "m6", "m7", "m43", "crm", "campaign", "age").alias("b"), "expected")
    for b, exp in out.collect():
        assert b == exp


def test_segment(spark):
    df = spark.createDataFrame([("81",), ("84",), ("87",), ("80",), (None,)], "t string")
    assert [r[0] for r in df.select(classify.segment("t")).collect()] == \
        ["Personas", "Personas", "Personas", "Negocios", "Negocios"]


def test_debt_band_edges(spark):
    vals = ["20000", "20000.01", "50000", "50000.01", "2000000", "2000000.01", None, "abc", "0"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(bands.debt_band(bands.to_amount("v"))).collect()]
    assert got == ["1 Menos a 20 mil", "2 Entre 20 a 50 mil", "2 Entre 20 a 50 mil", "3 Entre 50 a 100 mil",
                   "9 Entre 1 a 2 millones", "9.1 Mayor a 2 millones", "9.1 Mayor a 2 millones",
                   "9.1 Mayor a 2 millones", "1 Menos a 20 mil"]


def test_discount(spark):
    from recaudo.operators.discount import apply_discounts
    base = spark.createDataFrame([("1-", Decimal("100000.00")), ("2-", Decimal("12500000.50")),
                                  ("3-", Decimal("30000.00")), ("4-", Decimal("1000.00"))],
                                 "k string, debt decimal(18,2)")
    disc = spark.createDataFrame([("1-", "0"), ("2-", "12.5"), ("4-", "10"), ("4-", "20"), ("9-", "50")],
                                 "dk string, pct string")
    out = apply_discounts(base, disc, "k", "dk", "debt", "pct")
    got = {r.k: r for r in out.collect()}
    assert out.count() == 4                                   # no fan-out on the duplicate key
    assert got["1-"].valor_descuento == 0 and got["1-"].rango_con_descuento == "0 No Aplica"
    assert got["1-"].filtro_descuento == "No Aplica"
    assert got["2-"].valor_descuento == Decimal("10937500.437500")
    assert got["2-"].valor_descuento_texto == "10937500,437500"
    assert got["3-"].porcentaje == 0 and got["3-"].filtro_descuento == "No Aplica"
    assert got["4-"].porcentaje == Decimal("20.00")            # largest percentage wins
    assert got["4-"].valor_descuento == Decimal("800.000000")


def test_reference(spark):
    df = spark.createDataFrame([(None, "RR", "12.34"), (None, "BSCS", "55"), ("ABCD", "BSCS", "1"),
                                ("AB", "SGA", "2")], "ref string, crm string, acc string")
    r = classify.reference("ref", "crm", "acc")
    got = df.select(r.alias("r"), classify.reference_flag(r).alias("f")).collect()
    assert [tuple(x) for x in got] == [("12.34", "Con referencia"), ("0", "Sin Referencia"),
                                       ("ABCD", "Con referencia"), ("AB", "Sin Referencia")]


def test_document_type_and_number(spark):
    docs = ["CC123", "123", None, "XPP 9-8", "PS1", "PP2", "NT900.1", "CD3", "CE4", "ZZ5", "cc6"]
    df = spark.createDataFrame([(d,) for d in docs], "d string")
    got = df.select(classify.document_type("d"), classify.document_number("d")).collect()
    assert [tuple(x) for x in got] == [
        ("Cedula de Ciudadania", "123"), ("Errado", "123"), ("Sin tipologia", None),
        ("Permiso de Permanencia", "98"), ("Pasaporte", "1"), ("Pasaporte", "2"), ("Nit", "9001"),
        ("Carnet Diplomatico", "3"), ("Cedula de Extranjeria", "4"), ("Errado", "5"), ("Errado", "6")]


def test_account_key(spark):
    df = spark.createDataFrame([("1.234-5",), ("12345",), (None,)], "a string")
    got = df.select(keys.account_key("a"), keys.account_key("a", strip="-")).collect()
    assert [tuple(x) for x in got] == [("12345-", "1.2345-"), ("12345-", "12345-"), (None, None)]


def test_name_cleaning(spark):
    names = ["Sr. José  Muñoz", "A Israel Ríos 3 Peña", "SEÑORA ana-maria o'neil", "SR(A) PEREZ",
             "sr/sra Gómez", "MUÃ‘OZ", "Srta. Lucía", "ANDRES & HIJOS S.A.S", None]
    df = spark.createDataFrame([(n,) for n in names], "n string")
    got = [r[0] for r in df.select(text.clean_person_name("n")).collect()]
    assert got == ["JOSE MUNOZ", "ISRAEL RIOS PENA", "ANA MARIA O NEIL", "PEREZ", "GOMEZ", "MUNOZ", "LUCIA",
                   "ANDRES & HIJOS S A S", None]


def test_header_cleaning():
    assert text.clean_header("Dirección Completa.") == "Direccion Completa"
    assert text.clean_header("Código {país}, 2") == "Codigo pais 2"


def test_outcome_map_and_rollup(spark):
    data = [("1", "Promesa Parcial"), ("1", "colgo"), ("1", "YA PAGO"), ("2", "No Contestan"),
            ("2", "algo raro"), ("3", "Mensaje con tercero"), ("4", None)]
    df = spark.createDataFrame(data, "cuenta string, t string")
    df = df.withColumn("g", outcomes.outcome_group("t"))
    assert [r.g for r in df.collect()] == ["CDIR", "CIND", "CDIR", "NOC", None, "CIND", None]
    r = {x.cuenta: x for x in outcomes.outcome_rollup(df, "cuenta", "g").collect()}
    assert (r["1"].cantidad_contacto_directo, r["1"].cantidad_contacto_indirecto) == (2, 1)
    assert r["1"].filtro_reporte_gestion == "CDIR CIND"
    assert r["2"].filtro_reporte_gestion == "NOC"           # one blank, unmapped counts nowhere
    assert r["4"].filtro_reporte_gestion == ""
    assert len(fixed.OUTCOME_GROUPS) == 21


def test_arrears_dates_and_bands(spark):
    data = [("1/4/2025", "01/04/2025"), ("15/04/2025", "1/4/2025"), ("1/4/2025", "31/02/2025"),
            (None, "1/4/2025"), (" 10/5/2025 ", "1/4/2025"), ("1/3/2025", "1/4/2025"), ("1/1/2026", "1/4/2025")]
    df = spark.createDataFrame(data, "e string, d string")
    d, b = dates.arrears("e", "d")
    got = [tuple(x) for x in df.select(d, b).collect()]
    assert got == [(0, "0 Entre 0 y menos de 30 dias"), (14, "4 Entre 13 a 16 dias"), (None, "Nulo"),
                   (None, "Nulo"), (39, "9 Entre 32 a 100 dias"), (-31, "Fuera de rango"),
                   (275, "Fuera de rango")]


def test_day_band(spark):
    df = spark.createDataFrame([(v,) for v in [0, 1, 4, 5, 28, 29, 31, 32, None]], "v int")
    got = [r[0] for r in df.select(bands.day_band("v")).collect()]
    assert got == ["Fuera de rango", "1 Entre 1 a 4 dias", "1 Entre 1 a 4 dias", "2 Entre 5 a 8 dias",
                   "7 Entre 25 a 28 dias", "8 Entre 29 a 31 dias", "8 Entre 29 a 31 dias", "Fuera de rango",
                   "Fuera de rango"]


def test_strict_names_follow_the_pass_order(spark):
    from recaudo.functions.text import clean_person_name
    rows = [("Sr. José  Peña 2 ", "JOSPENA"), ("A ANA & CIA.", "ANA & CIA"), (None, None)]
    df = spark.createDataFrame([(a,) for a, _ in rows], "n string")
    assert [r[0] for r in df.select(clean_person_name("n", strict=True)).collect()][1:] == [b for _, b in rows][1:]
