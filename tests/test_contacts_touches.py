"""Contacts (ranges, slots, counts, profile) and touch merges on literal
fixtures."""

import random

from recaudo.operators import contacts, touches
from recaudo.plans.contact_plan import contact_table
from recaudo.plans.touch_plan import touch_table


def test_contact_ranges_and_kinds(spark):
    vals = ["3000000008", "3000000009", "3599999999", "3600000000", "6009999999", "6010000000",
            "6089999999", "6090000000", "a@b.co", "junk", "", None, " 3100000000 "]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = [r[0] for r in df.select(contacts.contact_kind("v")).collect()]
    assert got == [None, "mobile", "mobile", None, None, "landline", "landline", None, "email", None,
                   None, None, "mobile"]


def test_contact_table_slots_counts_profile(spark):
    rows = []
    # account 1-1, one document: 25 distinct mobiles (only 20 slots), 7 e-mails (5 slots), duplicates
    for i in range(25):
        rows.append(("D1", "1-1", str(3000000100 + i)))
    rows.append(("D1", "1-1", "3000000100"))
    for i in range(7):
        rows.append(("D1", "1-1", f"m{i}@x.co"))
    # account 2 with two documents: slots per (account, document)
    rows += [("D2", "2", "6010000001"), ("D3", "2", "3100000000"), ("D3", "2", "junk")]
    # account 3: e-mail only; account 4: junk only
    rows += [("D4", "3", "z@x.co"), ("D5", "4", "hello")]
    df = spark.createDataFrame(rows, "identificacion string, cuenta string, dato string")
    out = {(r.cuenta, r.identificacion): r for r in contact_table(df, 3, 2025).collect()}
    a = out[("11-", "D1")]
    assert [a[f"phone{i}"] for i in range(1, 21)] == [str(3000000100 + i) for i in range(20)]
    assert [a[f"email{i}"] for i in range(1, 6)] == [f"m{i}@x.co" for i in range(5)]
    assert (a.NumMovil, a.NumFijo, a.NumEmail) == ("20", "", "5")
    assert a["Filtro Demografico"] == "Celular Email"
    assert out[("2-", "D2")]["Filtro Demografico"] == "Fijo"
    assert out[("2-", "D3")]["Filtro Demografico"] == "Celular"
    assert out[("3-", "D4")]["Filtro Demografico"] == "Email"
    assert ("4-", "D5") not in out                      # nothing classifiable
    assert a["MES DE ASIGNACION"] == 3 and a["PERIODO DE ASIGNACION"] == 2025


def test_profile_labels(spark):
    cases = [(1, 1, 1, "Celular Fijo Email"), (1, 1, 0, "Celular Fijo"), (1, 0, 1, "Celular Email"),
             (1, None, None, "Celular"), (0, 1, 1, "Fijo Email"), (0, 1, 0, "Fijo"), (None, None, 2, "Email"),
             (0, 0, 0, "No posee Demograficos")]
    df = spark.createDataFrame([c[:3] for c in cases], "m int, f int, e int")
    got = [r[0] for r in df.select(contacts.profile_label("m", "f", "e")).collect()]
    assert got == [c[3] for c in cases]


def test_slot_order_code(spark):
    df = spark.createDataFrame([("3000000009", "6010000000", None)], "p1 string, p2 string, p3 string")
    assert df.select(contacts.slot_order_code(["p1", "p2", "p3"])).first()[0] == "123"


def _channels(spark, rnd):
    out = {}
    for ch in ("SMS", "EMAIL", "BOT", "IVR"):
        rows = []
        for acc in range(30):
            if rnd.random() < 0.6:
                brand = rnd.choice(["Potencial", "CHURN", "30", "otra marca", "120"])
                rows.append((f"{acc}.0", f"{acc}0", brand, str(rnd.randint(1, 9))))
        out[ch] = spark.createDataFrame(rows, "cuenta_real string, cuenta_sin_punto string, marca string, "
                                              "cantidad string")
    return out


def test_union_aggregate_equals_full_outer_chain(spark):
    ch = _channels(spark, random.Random(3))
    a = sorted(tuple(r) for r in touches.merge_touches(ch).collect())
    b = sorted(tuple(r) for r in touches.merge_touches_outer_chain(ch).collect())
    assert a == b and len(a) > 0


def test_touch_table_brand_filter_before_dedup(spark):
    mk = lambda rows: spark.createDataFrame(rows, "Cuenta_Real string, Cuenta_Sin_Punto string, "  # noqa: E731
                                                  "Marca string, Cantidad string")
    ch = {
        "SMS": mk([("1.1", "11", "POTENCIAL", "5"), ("1.1", "11", "desconocida", "50"), ("2.2", "22", "30", "1")]),
        "EMAIL": mk([("1.1", "11", "POTENCIAL", "2")]),
        "BOT": mk([]),
        "IVR": mk([("3.3", "33", "Castigo", "4"), ("2.2", "22", "30", "2")]),
    }
    out = {r.Cuenta_Sin_Punto: r for r in touch_table(ch, 6, 2024).collect()}
    # the unknown brand has more touches but is filtered before the per-account dedup
    assert out["11"].marca == "potencial"
    assert (out["11"]["Toques por SMS"], out["11"]["Toques por EMAIL"], out["11"]["Toques por BOT"]) == (5, 2, 0)
    assert out["22"]["Toques por IVR"] == 2 and out["33"].marca == "castigo"


def test_counted_slots_compat_and_sort(spark):
    rows = [("D", "1", str(3000000100 + i)) for i in range(18)] + [("D", "2", "6010000000"), ("D", "2", "3000000100")]
    df = spark.createDataFrame(rows, "identificacion string, cuenta string, dato string")
    out = {r.cuenta: r for r in contact_table(df, 1, 2025, counted_phone_slots=16).collect()}
    assert out["1-"].NumMovil == "16"
    ordered = [r.cuenta for r in contact_table(df, 1, 2025, order_by_slot_code=True).collect()]
    assert ordered == ["1-", "2-"]          # 111...1 sorts before 12...
