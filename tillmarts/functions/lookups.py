"""Values that results depend on, kept as plain data."""

# Colour code inside a variant code -> colour name. The first rule that is
# contained in the code wins, so the order is part of the meaning.
COLOUR_RULES = [
    ("AREN", "Arena"),
    ("AZUL", "Azul"),
    ("AZMA", "Azul Marino"),
    ("BLAN", "Blanco"),
    ("CALI", "Calipso"),
    ("CELE", "Celeste"),
    ("DAMA", "Damasco"),
    ("ROYA", "Royal"),
    ("SAND", "Sandia"),
    ("TURQ", "Turquesa"),
    ("CAQU", "Caqui"),
    ("INDG", "Indigo"),
    ("CEMA", "Celeste Mar"),
    ("CORA", "Coral"),
    ("CRUD", "Crudo"),
    ("CAPA", "Calipso Pastel"),
    ("AQUA", "Aqua"),
    ("GRPI", "Gris Piedra"),
    ("BEIG", "Beige"),
    ("VERD", "Verde"),
    ("ROSA", "Rosa"),
    ("CAFE", "Cafe"),
    ("NEGR", "Negro"),
    ("BLD", "Blanco Diseño"),
    ("MARE", "Marengo"),
    ("BLOY", "Blanco/Royal"),
    ("BLAM", "Blanco/Azul Marino"),
    ("MOST", "Mostaza"),
    ("VECL", "Verde Claro"),
    ("TERR", "Terracota"),
    ("MOVI", "Mostaza Vintage"),
    ("GRIS", "Gris"),
    ("LILA", "Lila"),
    ("CEDE", "Celeste Denin"),
    ("AZDE", "Azul Denin"),
    ("BEVE", "Beige/Verde"),
    ("OLIV", "Oliva"),
    ("ROJO", "Rojo"),
    ("BURD", "Burdeo"),
    ("MENT", "Menta"),
    ("PETR", "Petroleo"),
    ("ZULI", "Azulino"),
    ("MELO", "Melon"),
    ("LADR", "Ladrillo"),
    ("AMAR", "Amarillo"),
    ("CEOS", "Celeste Oscuro"),
    ("MORA", "Morado"),
    ("ROVI", "Rojo Vintage"),
    ("CAVE", "Cafe Verdoso"),
    ("AZAC", "Azul Acero"),
    ("VEBO", "Verde Botella"),
    ("AZPE", "Azul Petrol"),
    ("AZLA", "Azul Lavanda"),
    ("AZNA", "Azul Navy"),
    ("MOOS", "Morado Oscuro"),
    ("AROS", "Arena Oscuro"),
    ("AZGR", "Azul/Gris"),
    ("AZSA", "Azul/Sandia"),
    ("AZVE", "Azul/Verde"),
    ("DEAZ", "Denim/Azul"),
    ("SADE", "Sandia/Denim"),
    ("CETU", "Celeste/Turquesa"),
    ("TOST", "Tostado"),
    ("RGME", "Gris Medio"),
    ("BETA", "Beige Tan"),
    ("VECA", "Verde Caqui"),
    ("TAUP", "Taupe"),
    ("MASI", "Masilla"),
    ("DENI", "Denim"),
    ("BLAZ", "Blanco/Azul"),
]
COLOUR_OTHER = "Otro"

# Size label -> position in a size chart.
SIZE_ORDER = {"S": 1, "M": 2, "L": 3, "XL": 4, "XXL": 5, "3XL": 6, "4XL": 7}

# Branch id -> branch name.
OFFICES = {
    1: "PROVIDENCIA",
    2: "BUCAREST",
    3: "MONTEVIDEO",
    4: "APUMANQUE",
    5: "HUÉRFANOS",
}
OFFICE_OTHER = "OTRA OFICINA"

# Calendar names.
MONTHS = {
    1: "Enero",
    2: "Febrero",
    3: "Marzo",
    4: "Abril",
    5: "Mayo",
    6: "Junio",
    7: "Julio",
    8: "Agosto",
    9: "Septiembre",
    10: "Octubre",
    11: "Noviembre",
    12: "Diciembre",
}
WEEKDAYS = {  # 1 = Sunday
    1: "Domingo",
    2: "Lunes",
    3: "Martes",
    4: "Miércoles",
    5: "Jueves",
    6: "Viernes",
    7: "Sábado",
}

# Document types that count as sales, by name and by id; 9 is the credit note.
SALE_DOCUMENT_NAMES = [
    "NOTA DE CRÉDITO ELECTRÓNICA T",
    "FACTURA DE COMPRA ELECTRÓNICA",
    "BOLETA ELECTRÓNICA T",
    "FACTURA ELECTRÓNICA T",
    "NOTA DE DÉBITO ELECTRÓNICA T",
]
SALE_DOCUMENT_IDS = [9, 1, 18, 6, 19]
CREDIT_NOTE_ID = 9

# Ad actions turned into columns, and the types a purchase may be reported under.
ACTION_COLUMNS = [
    "page_engagement",
    "landing_page_view",
    "onsite_web_view_content",
    "post_engagement",
    "view_content",
    "video_view",
    "purchase",
    "add_to_cart",
    "initiate_checkout",
    "add_payment_info",
]
PURCHASE_TYPES = [
    "purchase",
    "onsite_web_purchase",
    "onsite_web_app_purchase",
    "offsite_conversion.fb_pixel_purchase",
    "omni_purchase",
    "web_in_store_purchase",
]
VIDEO_ATTACHMENT = "video_autoplay"
UNKNOWN = "unknown"

LOCAL_ZONE = "America/Santiago"
