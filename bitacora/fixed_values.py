"""Values that fix the results: patterns, word lists, dictionaries, column names.

Everything in this module is data.  The code that uses it lives elsewhere.
"""

# --------------------------------------------------------------------------
# Folio patterns.
# {n} is a run of digits, {s} one whitespace character, {w} the inside of a
# word-character class.  Every pattern ignores case; "." stops at a line feed.
# Each is (lead, core, tail): the core holds the folio numbers, the whole match
# is what leaves the text.
# --------------------------------------------------------------------------
FOLIO_DIGITS = 10

SPLIT_PATTERN = (
    r"(?:El incidente |Folio )?",
    r"{n}{s}+se dividio{s}+(?:a|al folio){s}+{n}",
    r"(?:.*?por [{w}() ]+)?",
)
LINKED_PATTERN = (
    r"(?:El incidente |Folio )?",
    r"{n}{s}+(?:ha sido |se ha )?ligado{s}+(?:al?|con el?){s}*(?:incidente|folio)?{s}*{n}",
    r"",
)
CANCELLED_PATTERN = (
    r"(?:El incidente |Folio )?",
    r"{n}",
    r"{s}+(?:fue )?cancelado{s}+por{s}+[{w}() ]+",
)
REFERENCE_PATTERN = (
    r"(?:EN )?REFERENCIA{s}+(?:A{s}+|AL{s}+)?(?:FOLIO{s}+)?",
    r"{n}",
    r"",
)

# --------------------------------------------------------------------------
# Text normalisation.
# {n} is one digit here.
# --------------------------------------------------------------------------
DATE_PATTERN = r"{n}{{1,2}}[/-]{n}{{1,2}}[/-]{n}{{2,4}}"
TIME_PATTERN = r"{n}{{1,2}}:{n}{{2}}(?::{n}{{2}})?"
MOJIBAKE_PAIR = r"[ÃÂ][\x80-\xBF]"
UNKNOWN_MARK = " <unk> "

SPANISH_STOP_WORDS = [
    "de", "la", "que", "el", "en", "y", "a", "los", "del", "se", "las", "por",
    "un", "para", "con", "no", "una", "su", "al", "lo", "como", "mas", "pero",
    "sus", "le", "ya", "o", "este", "si", "porque", "esta", "entre", "cuando",
    "muy", "sin", "sobre", "tambien", "me", "hasta", "hay", "donde", "quien",
    "desde", "todo", "nos", "durante", "todos", "uno", "les", "ni", "contra",
    "otros", "ese", "eso", "ante", "ellos", "e", "esto", "mi", "antes",
    "algunos", "que", "unos", "yo", "otro", "otras", "otra", "el", "tú", "te",
    "ti",
]

# --------------------------------------------------------------------------
# Phrase dictionary, category -> phrases.  The blank category
# deletes its phrases.
# --------------------------------------------------------------------------
PHRASES = {
    "estatus_atencion_despacho": [
        "est llegada", "est despachado", "est liberado", "despachado unidad",
        "est despachado unidad", "unidad ssc01 est",
    ],
    "monitoreo_seguimiento": [
        "enterado monitoreo", "enterado monitoreo conforme",
        "monitoreo conforme", "finaliza monitoreo",
    ],
    "ubicacion_arribo_lugar": [
        "arribar lugar", "hora arribo", "lugar atte", "lugar atte jvca",
        "lugar continuar", "lugar continuar recorrido", "retiramos lugar",
        "retiramos lugar continuar",
    ],
    "efectos_situacion_previa": [
        "efectos lugar", "efectos lugar atte", "anterior efectos",
        "anterior efectos lugar", "anterior efectos lugar atte",
    ],
    "solicitud_atencion_apoyo": [
        "solicita apoyo", "pide apoyo", "apoyo crp", "acude apoyo",
        "acude apoyo crp", "apoyo unidad", "apoyo seguridad",
    ],
    "corporaciones_autoridades": [
        "seguridad publica", "policia municipal", "polic municipal",
        "mando polic", "mando policia", "mando pea", "pea operaciones",
        "seguridad ciudadana", "seguridad vigilancia",
    ],
    "ssc_pms": [
        "ssc acude", "ssc acude crp", "ssc informa", "pms informa",
        "pms informa oficial", "unidad ssc01", "ssc01 est",
    ],
    "emergencias_911": [
        "emergencias 911", "servicio emergencias",
        "servicio emergencias 911", "realiza llamada",
    ],
    "unidades_bases": [
        "unidades unidad", "bases unidades", "bases unidades unidad",
        "modul bases", "modul bases unidades", "modul bases unidades unidad",
        "23 modul", "23 modul bases", "23 modul bases unidades",
        "23 modul bases unidades unidad",
    ],
    " ": [
        "reporta que", "reposta que su", "reposta que un", "reporta en",
        "reporta en el", "reporta el", "reporta que el", "reporta un",
        "reporta", "reporta una", "reporta a", "reprta",
    ],
}

# --------------------------------------------------------------------------
# Precinct id -> municipalities, with the misspelt, padded and
# broken (U+FFFD) spellings that occur in reports.
# --------------------------------------------------------------------------
PRECINCTS = {
    "1": ["TLAXCALA", "PANOTLA", "TOTOLAC"],
    "2": [
        "APETATITLAN DE ANTONIO CARVAJAL", "CHIUATEMPAN", "CHIAUTEMPAN",
        "AMAXAC DE GUERRERO", "CONTLA DE JUAN CUAMATZI",
        "SANTA CRUZ TLAXCALA", "LA MAGDALENA TLALTELULCO",
        "SAN FRANCISCO TETLANOHCAN",
    ],
    "3": [
        "APIZACO", "YAHUQUEMEHCAN", "YAUHQUEMEHCAN", "YAUHQUEMECAN",
        "TETLA DE LA SOLIDARIDAD", "XALOZTOC", "TOCATLAN", "TZOMPANTEPEC",
        "CUAXOMULCO", "SAN JOSE TEACALCO",
        "YAUHQUEMEHCAN                                     CIO",
    ],
    "4": [
        "HUAMANTLA", "TERRENATE", "IXTENCO",
        "ZILTLALTEPEC DE TRINIDAD SANCHEZ SANTOS", "LAZARO CARDENAS",
        "EMILIANO ZAPATA",
    ],
    "5": ["CUAPIAXTLA", "ATLTZAYANCA", "EL CARMEN TEQUEXQUITLA"],
    "6": ["TLAXCO", "ATLANGATEPEC"],
    "7": [
        "CALPULALPAN", "BENITO JUAREZ", "NANACAMILPA DE MARIANO ARISTA",
        "SANCTORUM DE LAZARO CARDENAS", "ESPAÑITA", "ESPA\ufffdITA",
    ],
    "8": [
        "NATIVITAS", "SANTA APOLONIA TEACALCO", "SAN DAMIAN TEXOLOC",
        "TETLATLAHUCA", "SAN JERONIMO ZACUALPAN", "SAN JUAN HUACTZINCO",
    ],
    "9": [
        "ZACATELCO", "SAN LORENZO AXOCOMANITLA", "SANTA CATARINA AYOMETLA",
        "TEPEYANCO", "SANTA ISABEL XILOXOXTLA", "SANTA CRUZ QUILEHTLA",
        "TEOLOCHOLCO", "XICOHTZINCO",
    ],
    "10": [
        "ACUAMANALA DE MIGUEL HIDALGO", "SAN PABLO DEL MONTE", "TENANCINGO",
        "PAPALOTLA DE XICOHTENCATL", "MAZATECOCHCO DE JOSE MARIA MORELOS",
    ],
    "11": [
        "IXTACUIXTLA DE MARIANO MATAMOROS", "TEPETITLA DE LARDIZABAL",
        "SANTA ANA NOPALUCAN",
    ],
    "12": [
        "SAN LUCAS TECOPILCO", "MUÑOZ DE DOMINGO ARENAS", "XALTOCAN",
        "HUEYOTLIPAN", "MU\ufffdOZ DE DOMINGO ARENAS",
    ],
    "13": ["OTROS MUNICIPIOS"],
}

# --------------------------------------------------------------------------
# Report columns.
# --------------------------------------------------------------------------
EXCLUDED_TYPES = ["70104"]

REQUIRED_COLUMNS = ["Folio", "Tipo de Incidente", "Notas"]

# Column in the working table -> column in the processed report, in order.
REPORT_COLUMNS = {
    "Folio": "Folio",
    "Fecha": "Fecha",
    "Tipo de Incidente": "Tipo de Incidente",
    "comisaria": "comisaria",
    "Municipio": "Municipio",
    "Hora de Recibido": "Hora de Recibido",
    "HORA_CIERRE": "HORA_CIERRE",
    "Latitud": "Latitud",
    "Longitud": "Longitud",
    "Coordenadas_": "Coordenadas",
    "Divididos": "Divididos",
    "folios_ligados": "folios_ligados",
    "cancelado": "cancelados",
    "referencia_folio": "referencia_folio",
    "nota_limpia": "Nota",
}

# Columns that note extraction adds.
EXTRACTION_COLUMNS = [
    "dividido_de", "dividido_a", "cancelado", "referencia_folio",
    "folios_ligados", "nota_limpia",
]

# Columns of the processed report that relate a folio to others.
RELATION_COLUMNS = ["Divididos", "folios_ligados", "referencia_folio"]

# Columns that the group join adds.
GROUP_COLUMNS = ["Folio_Key", "Grupo_ID", "Tamano_Grupo"]

# Cells that mean "missing" in a CSV report (the pandas defaults).
MISSING_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]
