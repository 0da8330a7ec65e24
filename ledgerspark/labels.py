"""Fixed values that appear in results."""

LENDER_A = "ARPESOD"
LENDER_B = "FINANSUEÑOS"
LENDER_B_TYPE = "DF"
LENDER_A_TITLE = "Arpesod"
LENDER_B_TITLE = "Finansueños"

# Invoices and items
INVOICE_NOT_FOUND = "NO ASIGNADA"
INVOICE_NO_TABLE = "NO DISPONIBLE"
INVOICE_NO_DATES = "ERROR DE FECHA"
NOT_APPLICABLE = "NO APLICA"
NOT_AVAILABLE = "NO DISPONIBLE"
GIFT_LIMIT = 6000

# Arrears
NO_ARREARS = "SIN MORA"
EXPIRED = "VIGENCIA EXPIRADA"
BAND_CURRENT = "AL DIA"
BAND_1_30 = "1 A 30"
BAND_31_90 = "31 A 90"
BAND_OVER_90 = "91 A 360"
BAND_UNKNOWN = "SIN INFO"

# Concepts of the balance extract
CAPITAL_CONCEPTS = ["CAPITAL", "ABONO DIF TASA"]
GUARANTEE_CONCEPT = "AVAL"
INTEREST_CONCEPT = "INTERES CORRIENTE"

# Sellers and guarantors
SELLER_ACTIVE = "SI"
SELLER_INACTIVE = "INACTIVO"
NO_GUARANTOR = "SIN CODEUDOR"

# Payments
SEVERAL_PORTFOLIOS = "Mas de una cartera"
NO_PORTFOLIO = "SIN CARTERA"
PAID_IN_FULL = "pago total"
NOVELTY_PAID = "Pago total"
NOVELTY_NONE = "Sin novedad"
GUARANTOR_PREFIX = "Codeudor:"
NO_AGENCY = "SIN CASA DE COBRANZA"
NO_EMPLOYEE = "NO"
EMPLOYEE = "SI"
SURPLUS_LIMIT = 10000

# Advances
TWO_LENDERS = "REVISAR TIENE 2 CARTERAS"
ADVANCE_PAID = "PAGO TOTAL"
AT_LENDER_B = "CARTERA EN FINANSUEÑOS"
AT_LENDER_A = "CARTERA EN ARPESOD"
CHECK_GUARANTOR = "REVISAR SI ES CODEUDOR"
SEVERAL_DOCUMENTS = "MAS DE UNA CARTERA"

# Bureau files
TO_CORRECT = "CORREGIR"
PERIODICITY = "05"
EMPTY_DATE = "00000000"
