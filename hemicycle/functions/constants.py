"""Word lists, names and patterns that outputs depend on."""

# Spanish and parliamentary stop words for baskets.
STOP_WORDS = (
    "a al algo algunas algunos ante antes aquel aquella aquellas aquellos aquí cada casi como con "
    "contra cual cuales cuando cuanta cuantas cuanto cuantos de del dentro donde dos el él ella "
    "ellas ellos en entre esa esas ese eso esos esta estas este estos lo los la las me mi mí mis "
    "nos nosotras nosotros o otra otras otro otros para pero poco por que qué se sí sin sobre su "
    "sus tu tú tus un una unas uno unos vosotras vosotros vuestra vuestras vuestro vuestros y ya "
    "senador presidente honorable secretario cámara comisión representante gracias palabra doctor "
    "tiene uso señor le usted doctora muchas es no vamos muy"
).split()

# Further words dropped before counting top words.
EXTRA_STOP_WORDS = (
    "orden ha entonces si presidencia presidente senadora señora honorables representantes"
).split()

TOP_WORD_STOP_WORDS = STOP_WORDS + [w for w in EXTRA_STOP_WORDS if w not in STOP_WORDS]

# Month names, January first.
MONTHS = (
    "enero febrero marzo abril mayo junio julio agosto septiembre octubre noviembre diciembre"
).split()

# Bold markers around headline text.
BOLD_OPEN, BOLD_CLOSE = "*b-*", "*-b*"

# Boilerplate removed from session text.
IMPRINT_PATTERN = r"IMPRENTA\s*NACIONAL\s*DE\s*COLOMBIA.*|www\.\w+\.gov\.co"
PAGE_PATTERN = r"Página\s*\d+|Edición\s*de.*páginas"
ISSUE_PATTERN = r"Año.*Nº.*"
ACT_PATTERN = r"ACTA NÚMERO \d+ DE \d+"

# A token made of letters only.
VALID_WORD_PATTERN = r"^[a-zA-ZáéíóúñÁÉÍÓÚÑüÜ]+$"

# Clusters kept for analysis, noise and unnamed clusters, display names.
USEFUL_CLUSTERS = (1, 2, 3, 6, 7, 9)
NOISE_CLUSTER = 2
UNREPRESENTED_CLUSTERS = (0, 4)
CLUSTER_NAMES = {
    1: "Sovereignty",
    2: "Executive efficiency",
    3: "Political Sagacity",
    6: "Congress",
    7: "Social Justice",
    9: "Health",
}

# Number words treated like digits.
NUMBER_WORDS = {
    "en": (
        "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen "
        "fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy "
        "eighty ninety hundred thousand million billion trillion"
    ).split(),
    "es": (
        "cero uno dos tres cuatro cinco seis siete ocho nueve diez once doce trece catorce quince "
        "dieciséis diecisiete dieciocho diecinueve veinte treinta cuarenta cincuenta sesenta "
        "setenta ochenta noventa cien mil millón billón trillón"
    ).split(),
}
