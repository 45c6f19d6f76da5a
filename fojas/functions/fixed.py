"""Fixed values that several modules share: word lists, tables and patterns, stated as they are."""

# Makes and the beginnings of their technical report codes.
REPORT_CODE_PREFIXES = [
    ("ALFA ROMEO", "AR"), ("ASTON MARTIN", "AM"), ("AUDI", "AD"), ("AUTORRAD", "AT"), ("BAIC", "BC"), ("BAW", "BW"), ("BENTLEY", "BT"), ("BMW", "BM"),
    ("BORGWARD", "BG"), ("BRILLIANCE", "BL"), ("BRILLIANCE", "BR"), ("BYD", "BY"), ("CADILLAC", "CD"), ("CITECAR", "CC"), ("CITROEN", "PG"),
    ("CITROEN", "CT"), ("CUPRA", "CP"), ("CHANGAN", "CN"), ("CHANGHE", "CN"), ("CHERY", "CY"), ("CHEVROLET", "CH"), ("CHRYSLER", "CR"),
    ("DAIHATSU", "DH"), ("DFLM", "DF"), ("DFLZ", "DL"), ("DFLZ", "DF"), ("DFM", "DF"), ("DFSK", "DS"), ("DFSK", "DF"), ("DODGE", "DD"),
    ("DONGFENG", "DF"), ("DS", "DC"), ("EAGLE", "EG"), ("EVEASY", "EV"), ("EXEED BORN FOR MORE", "EX"), ("FARIZON", "FA"), ("FAW", "BS"),
    ("FAW", "FW"), ("FERRARI", "FE"), ("FEST", "FS"), ("FIAT", "FT"), ("FORD", "FR"), ("FOTON", "FT"), ("FOTON", "FN"), ("FUSO", "FU"), ("GAC", "GC"),
    ("GAC GONOW", "GN"), ("GECKO", "GK"), ("GEELY", "GY"), ("GENESIS", "GS"), ("GONOW", "GN"), ("GREAT WALL", "GW"), ("HAFEI", "HF"), ("HAIMA", "HI"),
    ("HAVAL", "HV"), ("HINO", "HO"), ("HONDA", "HN"), ("HUANGHAI", "HG"), ("HUMMER", "HM"), ("HYUNDAI", "HY"), ("INFINITI", "NF"), ("IVECO", "IV"),
    ("JAC", "JC"), ("JAECOO", "JA"), ("JAGUAR", "JG"), ("JEEP", "JP"), ("JETOUR", "JT"), ("JIM", "JI"), ("JINBEI", "JB"), ("JMC", "JC"),
    ("JMC", "JM"), ("KAIYI", "KA"), ("KARRY", "KR"), ("KENBO", "KB"), ("KIA", "K"), ("KIA", "KI"), ("KING LONG", "KN"), ("KYC", "KY"), ("LADA", "LD"),
    ("LAMBORGHINI", "LM"), ("LAND ROVER", "LR"), ("LANDKING", "LK"), ("LANDWIND", "LW"), ("LEAPMOTOR", "LP"), ("LEXUS", "LX"), ("LIFAN", "LF"),
    ("LIVAN", "LV"), ("LOTUS", "LT"), ("LYNK CO", "LY"), ("M. BENZ", "MB"), ("MAHINDRA", "MH"), ("MAPLE", "MP"), ("MASERATI", "MS"), ("MAXUS", "MX"),
    ("MAZDA", "MZ"), ("MCLAREN", "MC"), ("MG", "MG"), ("MINI", "MN"), ("MINI", "BM"), ("MITSUBISHI", "MT"), ("MITSUBISHI FUSO", "FU"),
    ("NAMMI", "NM"), ("NAMMI", "MN"), ("NETA", "NT"), ("NISSAN", "NS"), ("OMODA", "OM"), ("OPEL", "OP"), ("PEUGEOT", "PG"), ("PIAGGIO", "GG"),
    ("PORSCHE", "PO"), ("PROTON", "PR"), ("R. SAMSUNG", "RS"), ("RAM", "RM"), ("RENAULT", "RN"), ("RIDDARA", "RD"), ("ROLLS-ROYCE", "RR"),
    ("SAAB", "SA"), ("SANGYONG", "SS"), ("SEAT", "ST"), ("SERES", "SE"), ("SHINERAY", "SH"), ("SKODA", "SK"), ("SKYWELL", "SY"), ("SMA MAPLE", "SP"),
    ("SMART", "SR"), ("SSANGYONG", "SS"), ("SUBARU", "SB"), ("SUZUKI", "SZ"), ("SWM", "SW"), ("TATA", "TT"), ("TESLA", "TS"), ("TOYOTA", "TY"),
    ("UAZ", "UZ"), ("VOLKSWAGEN", "VW"), ("VOLVO", "VL"), ("WELTMEISTER", "WT"), ("WULING", "WL"), ("ZNA", "ZN"), ("ZNA DONGFENG", "DF"),
    ("ZNA DONGFENG", "ZN"), ("ZOTYE", "ZT"), ("ZX", "ZX"), ("ZX AUTO", "ZX"),
]

# Document types, the phrases that name them, and what must not stand in a text for a phrase to count.
DOCUMENT_TYPES = {
    "SOLICITUD PRIMERA INSCRIPCION": [
        ("SOLICITUD PRIMERA INSCRIPCION", None), ("SOLICITUD DE PRIMERA INSCRIPCION", None), ("INSCRIPCION PRIMERA", None), ("SOLICITUDELECTRONICA", None),
        ("SOLICITUD ELECTRONICA DE PRIMERAINSCRIPCION", None), ("SOLICITUD ELECTRONICA DE PRIMERAINSCRIPCION R.V.M.", None),
        ("SOLICITUD ELECTRONICA DE PRIMERAINSCRIPCION RVM", None),
    ],
    "NOTA DE CREDITO ELECTRONICA": [("NOTA DE CREDITO ELECTRONICA", None)],
    "FACTURA ELECTRONICA": [
        ("FACTURA ELECTRONICA", None), ("FCTRA ELEC", None), ("FCT ELEC", None), ("FACT ELEC", None), ("ACTURA ELECTRONICA", None), ("FACTURAELECTRONICA", None),
    ],
    "NOTA DE CREDITO": [("NOTA DE CREDITO", None), ("NDC", None), ("NOT CRED", None), ("NOTA CREDITO", None)],
    "ORDEN DE COMPRA": [("ORDEN DE COMPRA", None), ("ORDEN COMPRA", None), ("ORDN DCOMPR", None), ("ORD DE COMPR", None)],
    "HOMOLOGADO": [
        ("HOMOLOGADO", None), ("CERTIFICADODECUMPLIMIENTO", None), ("D.S.55/94", None), ("55/94", None), ("55/94", "ONIH"), ("MINISTERIO DE TRANSPORTES Y", None),
    ],
    "CEDULA DE IDENTIDAD": [
        ("CEDULA DE IDENTIDAD", None), ("CED IDENTIDAD", None), ("CEDULA ID", None), ("CED ID", None), ("CEDULA DE", None), ("INCHL5", None), ("INCHLS", None),
    ],
    "ACTA DE RECEPCION": [
        ("ACTA DE RECEPCION", None), ("ACTA RECEPCION", None), ("RECEPCION BIENES", None), ("ACTA...DE RECEPCION CONFORME", None), ("ACTA DE RECEPCION CONFORME", None),
        ("ACTA DE RECEPCION CONFORME DE BIENES", None),
    ],
    "HOJA CONTROL DE PAGOS": [("HOJA CONTROL DE PAGOS", None)],
    "CONTRATO": [("CONTRATO", None)],
    "ROL UNICO TRIBUTARIO": [("ROL UNICO TRIBUTARIO", None)],
    "REVISION TECNICA": [
        ("REVISION TECNICA", None), ("CERTIFICADO EMISIONES CONTAMINANTES", None), ("REV TECNICA", None), ("CERT REV", None), ("REVISION TECNICA", "55/94"),
        ("REVISION TECNICA", "CERTIFICADO DE CUMPLIMIENTO"), ("EMISIONESCONTAMINANTES", None),
    ],
    "REGISTRO DE COMPRA": [("REGISTRO DE COMPRA", None)],
}

# Words at which the body of a sheet begins.
BODY_WORDS = [
    "DETALLE", "DETALLES", "DETALL1E", "DETAL1ES", "CÓDIGO", "CODIGO", "C0DIG0", "CÓD1G0", "DESCRIPCION", "DESCRIPCIÓN", "DESCR1PC1ON", "DESCR1PCION",
    "DOCUMENTO REF.", "DOCUMENTOS REFERENCIADOS", "DOCUMENT0", "D0CUMENT0", "NOMBRE ITEM", "NOMBRE ARTICULO", "N0MBRE", "ART1CULO",
    "POR LO SIGUIENTE", "P0R L0 S1GU1ENTE", "P0R L0 S1G.", "PORSIGUIENTE", "POR VENTA DE",
]

# Kinds of vehicle.
VEHICLE_TYPES = [
    "GRUA HORQUILLA", "CAMIONETA", "AUTOMOVIL", "CAMIÓN", "TRACTOCAMIÓN", "SUV", "REMOLQUE", "BUS", "GRUA", "MOTOCICLETA", "MOTO", "VEHÍCULO ELÉCTRICO",
    "MAQUINA INDUSTRIAL", "CARRO DE ARRASTRE", "MAQUINA AGRICOLA", "MAQUINARIAINDUSTRIAL", "BICICLETA MOTOR", "CHASIS CABINADO", "COCHE MORTUORIO",
    "MINIBUS PESADO", "TRICICLO MOTOR", "STATION WAGON", "CASA RODANTE", "SEMIREMOLQUE", "SEMIRREMOLQUE", "TRACTOCAMION", "TRACTO CAMION", "AMBULANCIA",
    "CARROBOMBA", "CUADRIMOTO", "CUATRIMOTO", "BICIMOTO", "LIMUSINA", "MICROBUS", "TROLEBUS", "MINIBUS", "OMNIBUS", "TRACTOR", "TRIMOTO", "CAMION", "FURGON",
    "BUGGI", "JEEP",
]

# Makes taken as valid, and used where no list of makes is given.
COMMON_MAKES = [
    "TOYOTA", "HYUNDAI", "FORD", "CHEVROLET", "NISSAN", "MITSUBISHI", "JEEP", "KIA", "PEUGEOT", "RENAULT", "FIAT", "VOLKSWAGEN", "BMW", "MERCEDES", "HONDA",
    "MAZDA", "SSANGYONG", "CITROEN", "JAC", "DFSK", "SUBARU", "CHERY", "SUZUKI", "BYD", "VOLVO", "FOTON", "MAXUS", "GEELY", "CHANGAN", "JETOUR", "FAW",
    "IVECO", "SCANIA", "DAEWOO", "MAN", "ISUZU", "RAM",
]
# Colours used where no list is given.
COMMON_COLOURS = ["ROJO", "AZUL", "VERDE", "NEGRO", "BLANCO", "AMARILLO", "MORADO", "GRIS", "NARANJA"]
# Kinds of bodywork used where no list is given.
BODY_KINDS = [
    "TRANSPORTE DE GAS", "ALJIBE (ESTANQUE PARA AGUA)", "ESTANQUE PARA COMBUSTIBLE", "ESTANQUE OTROS PRODUCTOS", "PORTA AUTOMOVILES", "PORTA CONTENEDOR", "OTRA (No SPIEV)",
    "PLATAFORMA BAJA", "GRUA PLATAFORMA", "FRIGORIFICO", "PLATAFORMA", "POLIBRAZO", "ASPIRADOR", "BASURERO", "BETONERA", "STANQUE", "BARANDA", "FURGON", "ALJIBE", "TOLVA", "GRUA",
]
# Axle arrangements.
AXLES = [
    "S4-S4", "S4-D8", "S4", "S2-D8", "D8", "T12", "S2-S4", "C16", "S2-S2", "D4-D8", "S2-T12", "D4-T12", "T10", "S2-D6", "E48", "D4", "S2", "C32", "D4-D6",
    "S2-D4", "D8-D8", "T6", "S4-T12", "D8-T12", "0-D16", "S4-C16", "E24", "S4-D10", "T-12",
]

# The lists the stricter score rules check against.
VALID_DOCUMENT_TYPES = [
    "FACTURA ELECTRONICA", "NOTA DE CREDITO ELECTRONICA", "NOTA DE CREDITO", "ORDEN DE COMPRA", "HOMOLOGADO", "CEDULA DE IDENTIDAD", "CONTRATO", "ROL UNICO TRIBUTARIO",
]
VALID_COLOURS = ["ROJO", "AZUL", "VERDE", "GRIS", "NEGRO", "BLANCO", "AMARILLO", "BEIGE", "CAFÉ", "PLATEADO"]
VALID_UNITS = ["KG", "CV", "KW"]
# Tenth signs of a vehicle identification number that stand for a model year.
YEAR_SIGNS = "ABCDEFGHJKLMNPRSTVWXY123456789"

# Number words with their values; those of 1,000 and more multiply.
AMOUNT_WORDS = {
    "UNO": 1, "DOS": 2, "TRES": 3, "CUATRO": 4, "CINCO": 5, "SEIS": 6, "SIETE": 7, "OCHO": 8, "NUEVE": 9, "DIEZ": 10, "ONCE": 11, "DOCE": 12, "TRECE": 13,
    "CATORCE": 14, "QUINCE": 15, "DIECISEIS": 16, "DIECISIETE": 17, "DIECIOCHO": 18, "DIECINUEVE": 19, "VEINTE": 20, "TREINTA": 30, "CUARENTA": 40,
    "CINCUENTA": 50, "SESENTA": 60, "SETENTA": 70, "OCHENTA": 80, "NOVENTA": 90, "CIEN": 100, "CIENTO": 100, "DOSCIENTOS": 200, "TRESCIENTOS": 300,
    "CUATROCIENTOS": 400, "QUINIENTOS": 500, "SEISCIENTOS": 600, "SETECIENTOS": 700, "OCHOCIENTOS": 800, "NOVECIENTOS": 900, "MIL": 1000,
    "MILLON": 1000000, "MILLONES": 1000000,
}
# Further number words, off unless asked for.
MORE_AMOUNT_WORDS = {
    "UN": 1, "UNA": 1, "VEINTIUN": 21, "VEINTIUNO": 21, "VEINTIDOS": 22, "VEINTITRES": 23, "VEINTICUATRO": 24, "VEINTICINCO": 25, "VEINTISEIS": 26,
    "VEINTISIETE": 27, "VEINTIOCHO": 28, "VEINTINUEVE": 29,
}
