"""Input tables and record layouts as data (fixed values of the file formats).

A table lists ``(source column, name, kind)``. Kinds: ``id`` (identifier text), ``text``,
``key`` (trimmed text), ``long``, ``money``, ``date``.
"""

from __future__ import annotations

from dataclasses import dataclass

Column3 = tuple[str, str, str]


@dataclass(frozen=True)
class Table:
    columns: tuple[Column3, ...]
    sheet: str | None = None
    skip_rows: int = 0
    positional: bool = False
    fill: str | None = None

    def names(self) -> list[str]:
        return [name for _, name, _ in self.columns]


def _same(*names: str) -> tuple[Column3, ...]:
    return tuple((n, n, "text") for n in names)


MONTHLY = {
    "ANALISIS": Table((
        ("direccion", "Direccion", "text"),
        ("barrio", "Barrio", "text"),
        ("nomciudad", "Nombre_Ciudad", "text"),
        ("diasatras", "Dias_Atraso", "long"),
        ("cuotaspag", "Cuotas_Pagadas", "long"),
        ("cedula", "Cedula_Cliente", "id"),
        ("saldofac", "Saldo_Factura", "money"),
        ("tipo", "Tipo_Credito", "text"),
        ("numero", "Numero_Credito", "long"),
    )),
    "R91": Table((
        ("VINNOMBRE", "Nombre_Cliente", "text"),
        ("MCDZONA", "Zona", "key"),
        ("MCDVINCULA", "Cedula_Cliente", "id"),
        ("MCDNUMCRU1", "Numero_Credito", "long"),
        ("VENNOMBRE", "Nombre_Vendedor", "text"),
        ("MCDTIPCRU1", "Tipo_Credito", "text"),
        ("VENCODIGO", "Codigo_Vendedor", "text"),
        ("MCDCCOSTO", "Codigo_Centro_Costos", "text"),
        ("MCDCOBRA", "Zona_Cobro", "text"),
        ("META_INTER", "Meta_Intereses", "money"),
        ("META_DC_AL", "Meta_DC_Al_Dia", "money"),
        ("META_DC_AT", "Meta_DC_Atraso", "money"),
        ("META_ATRAS", "Meta_Atraso", "money"),
    )),
    "VENCIMIENTOS": Table((
        ("MCNVINCULA", "Cedula_Cliente", "id"),
        ("SALDODOC", "Valor_Cuota_Vigente", "money"),
        ("VENCE", "Fecha_Cuota_Vigente", "date"),
        ("VINTELEFON", "Celular", "text"),
        ("MCNCUOCRU1", "Cuota_Vigente", "long"),
        ("MCNTIPCRU1", "Tipo_Credito", "text"),
        ("MCNNUMCRU1", "Numero_Credito", "long"),
    )),
    "R03": Table((
        ("CODEUDOR1", "Codeudor1", "text"),
        ("NOMBRE1", "Nombre_Codeudor1", "text"),
        ("VINTELEFON", "Telefono_Codeudor1", "text"),
        ("CIUNOMBRE1", "Ciudad_Codeudor1", "text"),
        ("CODEUDOR2", "Codeudor2", "text"),
        ("NOMBRE2", "Nombre_Codeudor2", "text"),
        ("VINTELEFO2", "Telefono_Codeudor2", "text"),
        ("CIUNOMBRE2", "Ciudad_Codeudor2", "text"),
        ("CEDULA", "Cedula_Cliente", "id"),
    ), fill="SIN CODEUDOR"),
    "SC04": Table((
        ("FACTURA", "Factura_Venta", "text"),
        ("SLCVALOR", "Valor_Cuota", "money"),
        ("SLCNCUOTAS", "Total_Cuotas", "long"),
    )),
    "CRTMPCONSULTA1": Table((
        ("CORREO", "Correo", "text"),
        ("FECHA_FACT", "Fecha_Facturada", "date"),
        ("TIPO_DOCUM", "Tipo_Credito", "text"),
        ("NUMERO_DOC", "Numero_Credito", "long"),
        ("IDENTIFICA", "Cedula_Cliente", "id"),
        ("NOMBRE_PRO", "Nombre_Producto", "text"),
        ("TOTVENTA", "Total_Venta", "money"),
        ("CANTIDAD", "Cantidad_Item", "money"),
    )),
    "FNZ003": Table((
        ("CONCEPTO", "Concepto", "text"),
        ("SALDO", "Saldo", "money"),
        ("DESEMBOLSO", "Tipo_Credito", "text"),
        ("NUMERO", "Numero_Credito", "long"),
    )),
    "MATRIZ_CARTERA": Table(_same(
        "Zona", "Cobrador", "Telefono_Cobrador", "Regional_Cobro", "Gestor", "Telefono_Gestor",
        "call_center_1_30_dias", "call_center_nombre_1_30", "call_center_telefono_1_30",
        "call_center_31_90_dias", "call_center_nombre_31_90", "call_center_telefono_31_90",
        "call_center_91_360_dias", "call_center_nombre_91_360", "call_center_telefono_91_360",
    ), skip_rows=2, positional=True),
    "METAS_FRANJAS": Table((
        ("ZONA", "Zona", "key"),
        ("1 A 30", "Meta_1_A_30", "text"),
        ("31 A 90", "Meta_31_A_90", "text"),
        ("91 A 180", "Meta_91_A_180", "text"),
        ("181 A 360", "Meta_181_A_360", "text"),
        ("T.R", "Total_Recaudo", "text"),
    )),
    "ASESORES": Table((
        ("CODIGO_VENDEDOR", "Codigo_Vendedor", "text"),
        ("JEFE VENTAS", "Jefe_ventas", "text"),
        ("MOVIL ASESOR", "Movil_Vendedor", "text"),
        ("LIDER ZONA", "Lider_Zona", "text"),
        ("MOVIL LIDER", "Movil_Lider", "text"),
    ), sheet="ASESORES"),
    "CENTRO_COSTOS": Table((
        ("CENTRO DE COSTOS", "Codigo_Centro_Costos", "text"),
        ("REGIONAL", "Regional_Venta", "text"),
    ), sheet="Centro Costos"),
    "DESEMBOLSOS_FINANSUEÑOS": Table((
        ("CRÉDITO", "Credito", "text"),
        ("VLR_FNZ", "Valor_Desembolso", "money"),
        ("CUOTAS", "Total_Cuotas", "long"),
        ("VLR_CUOTA", "Valor_Cuota", "money"),
    ), sheet="Page 001"),
}

# Cost centres are a sheet of the sellers' workbook, not a file type of their own.
FILE_TYPES = [name for name in MONTHLY if name != "CENTRO_COSTOS"]

_ACCOUNT = (
    ("CEDULA", "CEDULA", "id"),
    ("FACTURA", "FACTURA", "id"),
    ("saldofac", "SALDO", "money"),
    ("ccosto", "CENTRO_COSTO", "text"),
)

COLLECTIONS = {
    "AC FS": Table(_ACCOUNT),
    "AC ARP": Table(_ACCOUNT),
    # The guarantor table's two columns trade names.
    "CODEUDORES": Table((
        ("CODEUDOR", "DOCUMENTO_CODEUDOR", "id"),
        ("FACTURA", "CODEUDOR", "id"),
    )),
    "CASA DE COBRANZA": Table((
        ("FACTURA", "FACTURA", "id"),
        ("cobra", "CASA COBRANZA", "text"),
    )),
    "EMPLEADOS ACTUALES": Table((
        ("vincedula", "vincedula", "id"),
        ("ACTIVO", "ESTADO_EMPLEADO", "text"),
    )),
    "PAGOS BANCOLOMBIA": Table((
        ("No.", "No", "long"),
        ("Fecha", "Fecha", "date"),
        ("Detalle 1", "Detalle 1", "text"),
        ("Detalle 2", "Detalle 2", "text"),
        ("Referencia 1", "Referencia 1", "id"),
        ("Referencia 2", "Referencia 2", "id"),
        ("Valor", "Valor", "money"),
    )),
    "PAGOS EFECTY": Table((
        ("No", "No", "long"),
        ("Identificación", "Identificación", "id"),
        ("Valor", "Valor", "money"),
        ("N° de Autorización", "N° de Autorización", "text"),
        ("Fecha", "Fecha", "date"),
    )),
}

ADVANCES = {
    "ONLINE": Table((
        ("MCNTIPCRU1", "TIPO_RECIBO", "text"),
        ("MCNNUMCRU1", "No", "long"),
        ("MCNVINCULA", "CEDULA", "id"),
        ("VINNOMBRE", "NOMBRE", "text"),
        ("SALDODOC", "VALOR", "money"),
    )),
    "AC FS": Table((
        ("cobra", "ZONA_COBRADOR_FS", "text"),
        ("ccosto", "CENTRO_COSTO_FS", "text"),
        ("FACTURA", "FACTURA_FS", "id"),
        ("CEDULA", "CEDULA", "id"),
        ("saldofac", "ULTIMO_SALDO_FS", "money"),
    )),
    "AC ARP": Table((
        ("cobra", "ZONA_COBRADOR_ARP", "text"),
        ("ccosto", "CENTRO_COSTO_ARP", "text"),
        ("FACTURA", "FACTURA_ARP", "id"),
        ("CEDULA", "CEDULA", "id"),
        ("saldofac", "ULTIMO_SALDO_ARP", "money"),
    )),
}

CORRECTIONS = {
    "Cedulas a corregir": Table((
        ("CEDULA MAL", "bad", "text"), ("CEDULA CORRECTA", "good", "text"),
    )),
    "Vinculado": Table((
        ("CODIGO", "id", "text"), ("NOMBRE", "name", "text"), ("DIRECCI", "address", "text"),
        ("VINEMAIL", "email", "text"), ("TELEFONO", "phone", "text"),
    )),
    "FNZ001": Table((
        ("DSM_TP", "kind", "id"), ("DSM_NUM", "number", "id"), ("VLR_FNZ", "amount", "money"),
    )),
    "R05": Table((
        ("MCNTIPCRU2", "kind", "id"), ("MCNNUMCRU2", "number", "id"), ("ABONO", "amount", "money"),
    )),
    # Ours: the few names that are corrected by identifier, kept out of the code.
    "names": Table((("id", "id", "text"), ("full_name", "full_name", "text"))),
}


def id_type_columns(code: str) -> Table:
    return Table((("CEDULA CORRECTA", "id", "text"), (code, "code", "text")))


MONTHLY_ORDER = [
    "Empresa", "Credito", "Fecha_Facturada", "Factura_Venta", "Nombre_Producto",
    "Cantidad_Producto", "Obsequio", "Cantidad_Obsequio", "Cantidad_Total_Producto",
    "Cedula_Cliente", "Nombre_Cliente", "Correo", "Telefono", "Direccion", "Barrio",
    "Nombre_Ciudad", "Zona", "Cobrador", "Telefono_Cobrador", "Zona_Cobro", "Call_Center_Apoyo",
    "Nombre_Call_Center", "Telefono_Call_Center", "Regional_Cobro", "Gestor", "Telefono_Gestor",
    "Jefe_ventas", "Codigo_Vendedor", "Nombre_Vendedor", "Movil_Vendedor", "Vendedor_Activo",
    "Lider_Zona", "Movil_Lider", "Codigo_Centro_Costos", "Regional_Venta", "Codeudor1",
    "Nombre_Codeudor1", "Telefono_Codeudor1", "Ciudad_Codeudor1", "Codeudor2",
    "Nombre_Codeudor2", "Telefono_Codeudor2", "Ciudad_Codeudor2", "Valor_Desembolso",
    "Total_Cuotas", "Valor_Cuota", "Dias_Atraso", "Franja_Mora", "Saldo_Capital",
    "Saldo_Interes_Corriente", "Saldo_Avales", "Meta_Intereses", "Meta_General", "Meta_%",
    "Meta_$", "Meta_T.R_%", "Meta_T.R_$", "Cuotas_Pagadas", "Cuota_Vigente",
    "Fecha_Cuota_Vigente", "Valor_Cuota_Vigente", "Fecha_Cuota_Atraso", "Primera_Cuota_Mora",
    "Valor_Cuota_Atraso", "Valor_Vencido", "Meta_DC_Al_Dia", "Meta_DC_Atraso", "Meta_Atraso",
]

# Fixed-width layouts: (field, first position counted from 0, position after the last).
LAYOUT_A = [
    ("TIPO DE IDENTIFICACION", 0, 1),
    ("NUMERO DE IDENTIFICACION", 1, 12),
    ("NOMBRE COMPLETO", 30, 75),
    ("NUMERO DE LA CUENTA U OBLIGACION", 12, 30),
    ("FECHA APERTURA", 76, 84),
    ("FECHA VENCIMIENTO", 84, 92),
    ("RESPONSABLE", 92, 94),
    ("NOVEDAD", 107, 109),
    ("ESTADO ORIGEN DE LA CUENTA", 109, 110),
    ("VALOR INICIAL", 188, 199),
    ("VALOR SALDO DEUDA", 199, 210),
    ("VALOR DISPONIBLE", 210, 221),
    ("V CUOTA MENSUAL", 221, 232),
    ("VALOR SALDO MORA", 232, 243),
    ("TOTAL CUOTAS", 243, 246),
    ("CUOTAS CANCELADAS", 246, 249),
    ("CUOTAS EN MORA", 249, 252),
    ("FECHA LIMITE DE PAGO", 263, 271),
    ("FECHA DE PAGO", 271, 279),
    ("CIUDAD CORRESPONDENCIA", 577, 597),
    ("DIRECCION DE CORRESPONDENCIA", 625, 685),
    ("CORREO ELECTRONICO", 685, 745),
    ("CELULAR", 445, 457),
    ("SITUACION DEL TITULAR", 75, 76),
    ("EDAD DE MORA", 185, 188),
    ("FORMA DE PAGO", 105, 106),
    ("FECHA ESTADO ORIGEN", 110, 118),
    ("ESTADO DE LA CUENTA", 118, 120),
    ("FECHA ESTADO DE LA CUENTA", 120, 128),
    ("ADJETIVO", 137, 138),
    ("FECHA DE ADJETIVO", 138, 146),
    ("CLAUSULA DE PERMANENCIA", 252, 255),
    ("FECHA CLAUSULA DE PERMANENCIA", 255, 263),
]

LAYOUT_B = [
    ("tipo_identificacion", 1, 3),
    ("NUMERO DE IDENTIFICACION", 3, 18),
    ("nombre_tercero", 18, 78),
    ("fecha_limite_pago", 80, 88),
    ("numero_obligacion", 88, 108),
    ("codigo_sucursal", 108, 114),
    ("calidad", 114, 115),
    ("estado_obligacion", 119, 121),
    ("edad_mora", 121, 123),
    ("años_mora", 123, 125),
    ("fecha_corte", 125, 133),
    ("fecha_inicio", 133, 141),
    ("fecha_terminacion", 141, 149),
    ("fecha_exigibilidad", 149, 157),
    ("fecha_prescripcion", 157, 165),
    ("fecha_pago", 165, 173),
    ("modo_extincion", 173, 175),
    ("tipo_pago", 175, 177),
    ("periodicidad", 177, 179),
    ("cuotas_pagadas", 182, 185),
    ("cuotas_pactadas", 185, 188),
    ("cuotas_mora", 188, 191),
    ("valor_inicial", 191, 203),
    ("valor_mora", 203, 215),
    ("valor_saldo", 215, 227),
    ("valor_cuota", 227, 239),
    ("cargo_fijo", 239, 251),
    ("linea_credito", 251, 254),
    ("tipo_contrato", 257, 260),
    ("estado_contrato", 260, 263),
    ("vigencia_contrato", 263, 265),
    ("numero_meses_contrato", 265, 268),
    ("obligacion_reestructurada", 289, 291),
    ("naturaleza_reestructuracion", 291, 293),
    ("numero_reestructuraciones", 293, 296),
    ("Nº_cheques_devueltos", 298, 302),
    ("plazo", 304, 306),
    ("dias_cartera", 306, 312),
    ("direccion_casa", 329, 389),
    ("telefono_casa", 389, 409),
    ("codigo_ciudad_casa", 409, 415),
    ("ciudad_casa", 415, 435),
    ("codigo_departamento", 435, 438),
    ("departamento_casa", 438, 458),
    ("nombre_empresa", 458, 518),
    ("direccion_empresa", 518, 578),
    ("telefono_empresa", 578, 598),
    ("codigo_ciudad_empresa", 598, 604),
    ("ciuda_empresa", 604, 624),
    ("codigo_departamento_empresa", 624, 627),
    ("departamento_empresa", 627, 647),
    ("correo_electronico", 797, 857),
    ("numero_celular", 857, 917),
    ("valor_real_pagado", 917, 929),
]

# Field texts that stand for a missing value in a record.
NULL_TEXTS = [
    "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]
