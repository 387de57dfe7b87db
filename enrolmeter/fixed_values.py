"""Ids, words and lists that results depend on, stated as they are.

Nothing here is computed. Each block is a lookup a unit's accounting data uses, so a
change to one of them changes report results.
"""

# --- fixed values: site ids per business unit ------------------------------------------
POSTGRADUATE_SITES = (
    1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 18, 20, 22, 23, 25, 26, 37,
    50, 51, 52, 80, 125, 127, 128, 129, 132,
)
INITIAL_FEE_SITES = (24, 27, 28, 29, 30, 31, 32, 33, 42, 53, 107)
PARTNER_SITES = (
    1, 2, 3, 4, 5, 6, 7, 8, 14, 15, 16, 18, 20, 22, 23, 24, 25, 26, 27,
    28, 29, 30, 31, 32, 33, 37, 42, 50, 51, 52, 53, 80, 82, 86, 87, 88,
    89, 90, 91, 92, 93, 94, 95, 96, 97, 98, 99, 100, 102, 103, 104, 105,
    106, 107, 108, 109, 115, 116, 117, 118, 119, 120, 121, 122, 123,
    124, 125, 126, 127, 128, 129, 132, 134,
)
INSTITUTE_SITES = (49,)
CAREER_SITES = (9, 10, 48, 79)
KIDS_SITES = (11, 12, 13, 47, 81)
TECHNICAL_SITES = (39,)
SHORT_COURSE_SITES = (21, 34, 35, 36, 40, 44, 46, 78, 83, 114, 119)

# --- fixed values: partner institution ids ---------------------------------------------
POSTGRADUATE_INSTITUTIONS = (9,)
INITIAL_FEE_INSTITUTIONS = (49,)
PARTNER_INSTITUTIONS = (301, 307)

# --- fixed values: payment concept ids -------------------------------------------------
ENROLMENT_FEE = 1
TUITION = 2
MONTHLY_FEE = 8
CONTINUING_COURSE = 17
COURSE = 18
MONTHLY_FEE_SCHOOL = 27
INITIAL_FEE = 133
KIDS_COURSE = 311
PARTNER_INSTALMENT = 312

# --- fixed values: program categories --------------------------------------------------
COURSE_CATEGORY_NAMES = ("Esam Cursos", "Curso Modular")
CAREER_COURSE_CATEGORIES = (8, 9, 10)
KIDS_COURSE_CATEGORIES = (12, 13)
KIDS_MONTHLY_CATEGORIES = (14, 34, 35)

# --- fixed values: words shown in reports ----------------------------------------------
CASH_MARK = "CONTADO"
COURSE_MARK = "CURSO"
CASH_LABEL = "Contado"
CREDIT_LABEL = "Crédito"
NO_AGREEMENT_LABEL = "Sin Convenio"
ENROLLED = "INSCRITO"
NOT_ENROLLED = "NO INSCRITO"
UNIDENTIFIED = "NO IDENTIFICADO"
STATE_LABELS = (
    "PRE-INSCRITO", "INSCRITO", "RETIRADO", "CAMBIADO", "CONGELADO", "PAGADO",
)  # position = state code
MONTH_LABELS = (
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SEPTIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
)
