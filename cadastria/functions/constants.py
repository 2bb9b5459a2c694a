"""Labels, thresholds and word lists that results must spell exactly this way."""

# Nature of a sale and the kinds of premises found on source lines.
SALE_NATURE = "Vente"
FLAT = "Appartement"
HOUSE = "Maison"
OUTBUILDING = "Dépendance"
BUSINESS_PREFIX = "Local industriel"
DWELLINGS = [FLAT, HOUSE]

# Classes of a sale.
CLASS_MULTI = "Multi-logements"
CLASS_BUSINESS = "Local commercial"
CLASS_OUTBUILDING = "Dépendance seule"
CLASS_LAND = "Terrain / non bâti"
SALE_CLASSES = [FLAT, HOUSE, CLASS_MULTI, CLASS_BUSINESS, CLASS_OUTBUILDING, CLASS_LAND]

# Room classes.
ROOMS_NOT_DWELLING = "n/a"
ROOMS_UNKNOWN = "Inconnu"
ROOMS_LARGE = "T5+"

# Surface bands as (exclusive upper bound, label).
SURFACE_UNKNOWN = "Inconnue"
SURFACE_BANDS = [
    (30, "< 30 m²"),
    (50, "30-50 m²"),
    (80, "50-80 m²"),
    (120, "80-120 m²"),
    (None, "120 m² et +"),
]

# Distance bands to a station in service, then to a planned one.
STATION_BANDS = [
    (500, "1. Moins de 500 m"),
    (1000, "2. 500 m à 1 km"),
    (2000, "3. 1 à 2 km"),
    (None, "4. Plus de 2 km"),
]
PLANNED_BANDS = [
    (800, "1. Moins de 800 m"),
    (1500, "2. 800 m à 1,5 km"),
    (3000, "3. 1,5 à 3 km"),
    (None, "4. Plus de 3 km"),
]

# Market positions of a scored sale.
POSITION_UNDER = "Sous le marché (< -20 %)"
POSITION_SLIGHTLY_UNDER = "Légèrement sous (-20 à -10 %)"
POSITION_MARKET = "Au prix du marché (±10 %)"
POSITION_SLIGHTLY_ABOVE = "Légèrement au-dessus (10 à 20 %)"
POSITION_ABOVE = "Au-dessus du marché (> 20 %)"

# Reliable price per square metre and smallest dwelling.
RELIABLE_MIN, RELIABLE_MAX = 1000, 30000
MIN_DWELLING_M2 = 9

# Search radii in metres, and the Earth radius used for distances.
STATION_RADIUS_M = 5000
PLANNED_RADIUS_M = 10000
NEAR_STATION_M = 1000
EARTH_RADIUS_M = 6371010.0

# Transport modes, heaviest first; the tramway is not heavy transport.
MODE_PRIORITY = ["RER", "METRO", "TRAIN", "VAL", "TRAMWAY"]
HEAVY_MODES = ["METRO", "RER", "TRAIN", "VAL"]
EXCLUDED_PLANNED_MODE = "bus"
PLANNED_METRO_PATTERN = "^m[ée]tro 1[5-8]"

# Energy labels.
ENERGY_LABELS = ["A", "B", "C", "D", "E", "F", "G"]
ENERGY_GOOD = ["A", "B"]
ENERGY_BAD = ["F", "G"]

# Month names in calendar order.
MONTH_NAMES = [
    "janvier", "février", "mars", "avril", "mai", "juin", "juillet", "août",
    "septembre", "octobre", "novembre", "décembre",
]

# The department seed (code, name, zone).
ZONE_CITY = "Paris"
ZONE_INNER = "Petite couronne"
ZONE_OUTER = "Grande couronne"
ZONES = [ZONE_CITY, ZONE_INNER, ZONE_OUTER]
DEPARTMENTS = [
    ("75", "Paris", ZONE_CITY),
    ("77", "Seine-et-Marne", ZONE_OUTER),
    ("78", "Yvelines", ZONE_OUTER),
    ("91", "Essonne", ZONE_OUTER),
    ("92", "Hauts-de-Seine", ZONE_INNER),
    ("93", "Seine-Saint-Denis", ZONE_INNER),
    ("94", "Val-de-Marne", ZONE_INNER),
    ("95", "Val-d'Oise", ZONE_OUTER),
]
CITY_DEPARTMENT = "75"
FALLBACK_YEARS = ["2021", "2022", "2023", "2024", "2025"]

# Columns kept from the raw sale files, in order.
RAW_COLUMNS = [
    "id_mutation", "date_mutation", "nature_mutation", "valeur_fonciere", "adresse_numero",
    "adresse_nom_voie", "code_postal", "code_commune", "nom_commune", "code_departement",
    "id_parcelle", "nombre_lots", "code_type_local", "type_local", "surface_reelle_bati",
    "nombre_pieces_principales", "surface_terrain", "longitude", "latitude",
]

# Columns kept from the station files.
STATION_COLUMNS = [
    "id_gares", "nom_gares", "mode", "res_com", "indice_lig", "exploitant", "principal",
    "latitude", "longitude",
]
PLANNED_COLUMNS = [
    "nom_arret", "id_projet", "nom_projet", "mode", "sous_mode", "indice", "phase", "statut",
    "creation", "cor_exist", "latitude", "longitude",
]

# Income columns found by keywords in the normalised header.
INCOME_KEYWORDS = {
    "code_commune": ["code geographique"],
    "libelle_commune": ["libelle geographique"],
    "nb_menages": ["disp", "nbre de menages fiscaux"],
    "revenu_median": ["disp", "mediane"],
    "revenu_d1": ["disp", "1er decile"],
    "revenu_d9": ["disp", "9e decile"],
    "part_pensions_pct": ["disp", "part des pensions"],
}

# Marker that stands for NULL inside a surrogate key.
KEY_NULL_MARKER = "_dbt_utils_surrogate_key_null_"

# Disclosure control, colours from cheapest to dearest, landing gate, freshness.
MIN_GROUP_SALES = 5
PALETTE = ["#228B22AA", "#9ACD32AA", "#FFC800AA", "#FF7800AA", "#C81E1EAA"]
MIN_RAW_ROWS = 1_000_000
FRESHNESS_WARN_DAYS, FRESHNESS_ERROR_DAYS = 35, 55
MIN_COVERAGE = 0.95

# File synchronisation statuses.
FILE_ABSENT, FILE_CACHED, FILE_NEW, FILE_UPDATED = "absent", "cache", "nouveau", "mis à jour"
