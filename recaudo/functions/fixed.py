"""Fixed values.

FIXED VALUES: these labels, bounds, code lists and maps must equal the ones
the portfolio reports already use, or the outputs would not be comparable
month over month. They are stated here once, in their natural order, and
every operator reads them from here (as small literal tables / CASE chains).
"""

from __future__ import annotations

# --- FIXED VALUES (begin) -------------------------------------------------

# Debt bands: inclusive upper bound (pesos) -> label; above the last bound
# (and for a missing amount) the overflow label applies.
DEBT_BANDS = [
    (20000, "1 Menos a 20 mil"),
    (50000, "2 Entre 20 a 50 mil"),
    (100000, "3 Entre 50 a 100 mil"),
    (150000, "4 Entre 100 a 150 mil"),
    (200000, "5 Entre 150 mil a 200 mil"),
    (300000, "6 Entre 200 mil a 300 mil"),
    (500000, "7 Entre 300 mil a 500 mil"),
    (1000000, "8 Entre 500 mil a 1 Millon"),
    (2000000, "9 Entre 1 a 2 millones"),
]
DEBT_BAND_OVER = "9.1 Mayor a 2 millones"
DISCOUNT_BAND_ZERO = "0 No Aplica"

# Day bands: inclusive [low, high] -> label; anything else "Fuera de rango".
DAY_BANDS = [
    (1, 4, "1 Entre 1 a 4 dias"),
    (5, 8, "2 Entre 5 a 8 dias"),
    (9, 12, "3 Entre 9 a 12 dias"),
    (13, 16, "4 Entre 13 a 16 dias"),
    (17, 20, "5 Entre 17 a 20 dias"),
    (21, 24, "6 Entre 21 a 24 dias"),
    (25, 28, "7 Entre 25 a 28 dias"),
    (29, 31, "8 Entre 29 a 31 dias"),
]
DAY_BAND_OUT = "Fuera de rango"
# Arrears variant: one band before and one after the day bands, and a label
# for a missing value.
ARREARS_BAND_LOW = (-30, 0, "0 Entre 0 y menos de 30 dias")
ARREARS_BAND_HIGH = (32, 100, "9 Entre 32 a 100 dias")
ARREARS_BAND_NULL = "Nulo"

# Brand rules, first match wins. mark_potential / mark_prepotential /
# mark_writeoff / mark_refinanced are Y/N marks, crm the billing system.
BRAND_POTENCIAL = "Potencial"
BRAND_CHURN = "Churn"
BRAND_PROVISION = "Provision"
BRAND_PREPOTENCIAL = "Prepotencial"
BRAND_PRECHURN = "Prechurn"
BRAND_PREPROVISION = "Preprovision"
BRAND_CASTIGO = "Castigo"
BRAND_POTENCIAL_A_CASTIGAR = "Potencial a Castigar"
BRAND_ARREARS_MERGED = ("120", "150", "180")
BRAND_ARREARS_MERGED_LABEL = "120 - 180"
BRAND_PREPOTENCIAL_ESPECIAL = "Prepotencial Especial"
PREPOTENCIAL_ESPECIAL_CAMPAIGNS = (
    "PrePotencial Convergente Masivo_2",
    "PrePotencial Convergente Pyme_2",
)

# Customer segment: these customer-type codes are persons, the rest business.
PERSON_CUSTOMER_TYPES = ("81", "84", "87")
SEGMENT_PERSON = "Personas"
SEGMENT_BUSINESS = "Negocios"

# Document type letters -> document type name.
DOCUMENT_TYPES = [
    ("CC", "Cedula de Ciudadania"),
    ("PS", "Pasaporte"),
    ("PP", "Pasaporte"),
    ("XPP", "Permiso de Permanencia"),
    ("NT", "Nit"),
    ("CD", "Carnet Diplomatico"),
    ("CE", "Cedula de Extranjeria"),
]
DOCUMENT_TYPE_NULL = "Sin tipologia"
DOCUMENT_TYPE_OTHER = "Errado"

# Reference filler.
REFERENCE_DEFAULT = "0"
REFERENCE_WITH = "Con referencia"
REFERENCE_WITHOUT = "Sin Referencia"

# Assignment calendar labels.
DAY_ASSIGNED = "Asignada"
DAY_GAP = "Sin reasignar"
DAY_WITHDRAWN = "Retirada"
STATUS_ACTIVE = "En gestion"
STATUS_RECOVERED = "Recuperada"
NO_EXIT_DATE = "-"

# Flags.
APPLIES = "Aplica"
NOT_APPLIES = "No aplica"
DISCOUNT_APPLIES = "Aplica"
DISCOUNT_NOT_APPLIES = "No Aplica"
LIST_FLAG = "APLICA"

# Phone ranges (10-digit numbers). Keep: mobile and landline ranges used to
# pick contact numbers; count: the ranges used to count them per slot.
MOBILE_RANGE = (3000000009, 3599999999)
LANDLINE_RANGE = (6010000000, 6089999999)
MOBILE_COUNT_RANGE = (3000000009, 3599999999)
LANDLINE_COUNT_RANGE = (6000000009, 6599999999)
PHONE_SLOTS = 20
EMAIL_SLOTS = 5
DAY_SLOTS = 31

# Contact profile labels, in order of precedence.
PROFILE_LABELS = [
    ((True, True, True), "Celular Fijo Email"),
    ((True, True, None), "Celular Fijo"),
    ((True, None, True), "Celular Email"),
    ((True, None, None), "Celular"),
    ((None, True, True), "Fijo Email"),
    ((None, True, None), "Fijo"),
    ((None, None, True), "Email"),
]
PROFILE_NONE = "No posee Demograficos"

# Portfolio brands kept by the touch merge (compared in lower case).
PORTFOLIO_BRANDS = [
    "0", "30", "potencial", "prechurn", "churn", "prepotencial",
    "60", "90", "120", "150", "180", "210", "apple manual",
    "prepotencial especial", "castigo", "provision", "preprovision",
]

# Touch channels in output order.
TOUCH_CHANNELS = ["SMS", "EMAIL", "BOT", "IVR"]

# Contact outcome (lower case, blanks removed) -> outcome group.
OUTCOME_GROUPS = {
    "aldia": "CDIR",
    "colgo": "CIND",
    "dificultaddepago": "CDIR",
    "fallecido": "NOC",
    "interesadoenpagar": "CDIR",
    "mensajecontercero": "CIND",
    "noasumedeuda": "CDIR",
    "nocontestan": "NOC",
    "numeroerrado": "NOC",
    "posiblefraude": "CDIR",
    "promesa": "CDIR",
    "promesaincumplida": "CDIR",
    "promesaparcial": "CDIR",
    "reclamacion": "CDIR",
    "recordatorio": "CDIR",
    "renuente": "CDIR",
    "terceronotomamensaje": "CIND",
    "volverallamar": "CDIR",
    "yapago": "CDIR",
    "singestion": "NOC",
    "gestionivr": "CIND",
}
OUTCOME_GROUP_ORDER = ["CDIR", "CIND", "NOC"]

# Department names a city lookup may resolve to.
DEPARTMENTS = [
    "ARAUCA", "CASANARE", "CAUCA", "CHOCO", "N. DE SANTANDER",
    "GUAVIARE", "CESAR", "CORDOBA", "SANTANDER", "CAQUETA",
    "CALDAS", "SAN ANDRES", "MAGDALENA", "LA GUAJIRA", "RISARALDA",
    "QUINDIO", "SUCRE", "GUAINIA", "PUTUMAYO", "VAUPES",
    "ANTIOQUIA", "HUILA", "VICHADA", "ATLANTICO", "META",
    "AMAZONAS", "BOLIVAR", "CUNDINAMARCA", "BOYACA", "NARINO",
    "VALLE DEL CAUCA", "TOLIMA",
]
CITY_EMPTY = "VACIO"
CITY_UNRESOLVED = "NO IDENTIFICADO"

# Sending window for campaign messages (inclusive, hour and minute).
SEND_WINDOW = ((8, 0), (18, 59))

# Column-family prefixes of the consolidated table.
PREFIX_BASE = "BG_"
PREFIX_SCIENCE = "DS_VAR_"
PREFIX_ADDED = "AD_"
PREFIX_SLOTS = "FLT_"

# ---- report column names (fixed values)

# assignment base: leading and trailing columns of the report
ASSIGNMENT_LAYOUT = ["DOCUMENTO", "TIPO DE DOCUMENTO", "CUENTA", "CUENTA_NEXT", "MARCA", "CRM", "SEGMENTO",
          "CUSTOMER TYPE", "RANGO DEUDA", "VALOR DEUDA", "FECHA INGRESO", "FECHA RETIRO",
          "FECHA VENCIMIENTO", "GRUPO RANGO DE DIAS", "RANGO DE DIAS", "DIAS ASIGNADA",
          "DIAS RETIRADA", "REFERENCIA", "FILTRO REFERENCIA", "NOMBRE", "ESTADO CUENTA",
          "MES DE ASIGNACION", "PERIODO DE ASIGNACION"]
ASSIGNMENT_TAIL = ["PORCENTAJE", "VALOR DESCUENTO", "RANGO CON DESCUENTO", "MULTICUENTA", "MULTIPRODUCTO",
        "MULTIMORA"]

# monthly consolidation: base columns that are dropped first
BASE_DROP = ["COLUMNA 2", " COLUMNA 3", "COLUMNA 4", "SEGMENTO55", "SEGMENTO", "MULTIPRODUCTO"]
# the base's columns that the monthly report keeps (after renames and header cleaning)
BASE_COLUMNS = [
    "Nmero de Cliente", "[AccountAccountCode?]", "CRM_ORIGEN", "Edad de Deuda", "[PotencialMark?]",
    "[PrePotencialMark?]", "[WriteOffMark?]", "Monto inicial", "[ModInitCta?]", "[DeudaRealCuenta?]",
    "[BillCycleName?]", "Nombre Campaa", "[DebtAgeInicial?]", "Nombre Casa de Cobro", "Fecha de asignacin",
    "Deuda Gestionable", "Direccin Completa", "[Documento?]", "[AccStsName?]", "Ciudad", "[InboxName?]",
    "Nombre del Cliente", "Id de Ejecucion", "Fecha de Vencimiento", "Numero Referencia de Pago", "MIN", "Plan",
    "Cuotas Aceleradas", "Fecha de Aceleracion", "Valor Acelerado", "Intereses Contingentes",
    "Intereses Corrientes Facturados", "Intereses por mora facturados", "Cuotas Facturadas",
    "Iva Intereses Contigentes Facturado", "Iva Intereses Corrientes Facturados",
    "Iva Intereses por Mora Facturado", "Precio Subscripcion", "Cdigo de proceso", "[CustomerTypeId?]",
    "[RefinanciedMark?]", "[Discount?]", "[Permanencia?]", "[DeudaSinPermanencia?]", "Telefono 1", "Telefono 2",
    "Telefono 3", "Telefono 4", "Email", "[ActivesLines?]", "MARCA_ASIGNACION", "CUENTA_NEXT", "SALDO",
    "SEGMENTO_ASIGNACION", "RANGO", "FECHA INGRESO", "FECHA SALIDA", "VALOR PAGO", "VALOR PAGO REAL",
    "FECHA ULT PAGO", "DESCUENTO", "EXCLUSION DCTO", "LIQUIDACION", "TIPO DE PAGO", "PAGO"]
# output catalogue of the derived columns (names the monthly reports use)
SCIENCE = ["NOMBRE_CAMPANA", "CRM", "MULTIPRODUCTO", "MULTIMORA", "MULTICUENTA", "RANGO_DEUDA",
           "RANGO CON DESCUENTO", "TIPO_DE_DOCUMENTO", "DEPARTAMENTO", "RANGO_DE_DIAS_ASIGNADA",
           "RANGO_DE_DIAS_EN_BASE", "RANGO_DE_DIAS_RETIRADA", "RANGO_DE_DIAS_MORA",
           "FILTRO_REPORTE_GESTION", "FILTRO_REFERENCIA", "FILTRO_DEMOGRAFICOS", "CANTIDAD_DEMOGRAFICOS",
           "CANTIDAD_MOVILES", "CANTIDAD_FIJOS", "CANTIDAD_EMAILS", "CANTIDAD_CONTACTO_DIRECTO",
           "CANTIDAD_CONTACTO_INDIRECTO", "CANTIDAD_NOCONTACTO", "CUSTOMER_TYPE", "DIAS_ASIGNADA",
           "DIAS_EN_BASE", "DIAS_RETIRADA", "DIAS_MORA"]
ADDED = ["ESTADO CUENTA", "FILTRO DESCUENTO", "FILTRO_PAGOS_SIN_APLICAR", "FILTRO_PAGOS_NO_GESTION",
         "EXCLUSION CUENTA", "EXCLUSION DOCUMENTO", "ESTADO RANKING", "SERVICIOS RANKING",
         "RECUENTO PAGOS SIN APLICAR", "RECUENTO NO GESTION", "FILTRO COLAS"] + \
    [f"Toques por {ch}" for ch in TOUCH_CHANNELS]
FINAL = ["FECHA INGRESO DATA", "FECHA RETIRO DATA", "CUENTA", "DOCUMENTO", "NOMBRE"]
# renames applied after the joins (names the monthly reports use)
RENAMES = {"CRM Origen": "CRM_ORIGEN", "TIPO DE DOCUMENTO": "TIPO_DE_DOCUMENTO",
           "Marca": "MARCA_ASIGNACION", "MARCA DATA": "NOMBRE_CAMPANA",
           "SEGMENTO": "SEGMENTO_ASIGNACION", "RANGO DEUDA": "RANGO_DEUDA",
           "GRUPO RANGO DE DIAS": "RANGO_DE_DIAS_ASIGNADA", "FILTRO REFERENCIA": "FILTRO_REFERENCIA",
           "Filtro Demografico": "FILTRO_DEMOGRAFICOS", "CUSTOMER TYPE": "CUSTOMER_TYPE",
           "DIAS ASIGNADA": "DIAS_EN_BASE", "RANGO DE DIAS": "DIAS_ASIGNADA",
           "DIAS RETIRADA": "DIAS_RETIRADA", "NumMovil": "CANTIDAD_MOVILES",
           "NumFijo": "CANTIDAD_FIJOS", "NumEmail": "CANTIDAD_EMAILS"}

# strict name cleaning: letters repaired, then texts (regular expressions) deleted one after the other
STRICT_N = ["\\ÃƒÂ‘", "\\Ã‚Â¦", "\\Ã‘", "Ñ", "ÃƒÂ‘", "Ã‚Â¦", "Ã‘"]
STRICT_LETTERS = [("Ã‡", "A"), ("ÃƒÂ", "I")]
STRICT_DELETED = [
    "SR/SRA", "SR./SRA.", "SR/SRA.", "SR.", "SRA.", "SR(A).", "SR ", "SRA ", "SR(A)", "\\.", "#", "$", "/", "<", ">",
    "\\*", "SEÑORES ", "SEÑOR(A) ", "SEÑOR ", "SEÑORA ", "SENORES ", "SENOR(A) ", "SENOR ", "SENORA ", "¡", "!", "\\?",
    "¿", "_", "-", "}", "\\{", "\\+", "0 ", "1 ", "2 ", "3 ", "4 ", "5 ", "6 ", "7 ", "8 ", "9 ", "0", "1", "2", "3", "4",
    "5", "6", "7", "8", "9", "  "]
STRICT_DELETED_LAST = ["SEORES ", "SEORA ", "SEOR ", "SEORA "]

# --- FIXED VALUES (end) ---------------------------------------------------
