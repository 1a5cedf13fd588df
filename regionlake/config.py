"""Parameters and fixed reference values.

Everything a job compares against (bands, weights, thresholds, default tables)
is collected here, so that a job for another territory passes its own values.
"""

from __future__ import annotations

from dataclasses import dataclass, field

# Column names of the public tables.
REGION = "arrondissement"
YEAR = "annee"

# The region domain and the postal / commune code layout.
N_REGIONS = 20
POSTAL_PREFIX = "750"
COMMUNE_PREFIX = "751"
COMMUNE_BASE = 75100
YEARS = (2021, 2022, 2023, 2024)


@dataclass(frozen=True)
class SaleRules:
    """Bands a transaction has to satisfy (fixed values)."""

    nature: str = "Vente"
    kinds: tuple[str, ...] = ("Appartement", "Maison")
    min_surface: float = 5.0  # strict
    min_value: float = 1000.0  # strict
    min_unit_price: float = 1000.0  # inclusive
    max_unit_price: float = 50000.0  # inclusive


@dataclass(frozen=True)
class Box:
    """Inclusive latitude / longitude box."""

    lat_min: float
    lat_max: float
    lon_min: float
    lon_max: float


# Point boxes (the security layer starts further west).
POINT_BOX = Box(48.8, 48.92, 2.26, 2.42)
SECURITY_BOX = Box(48.80, 48.92, 2.25, 2.42)

# Tag -> class of a point of interest.
SHOP_CLASSES = {
    "supermarket": "supermarche",
    "convenience": "supermarche",
    "mall": "centre_commercial",
    "bakery": "boulangerie",
    "pharmacy": "pharmacie",
}
HEALTH_CLASSES = {
    "hospital": "hopital",
    "clinic": "hopital",
    "doctors": "medecin",
    "dentist": "dentiste",
}
# Class -> count column of the shops and health table.
SHOP_COUNT_COLUMNS = {
    "supermarche": "nb_supermarches",
    "pharmacie": "nb_pharmacies",
    "boulangerie": "nb_boulangeries",
    "centre_commercial": "nb_centres_commerciaux",
}
HEALTH_COUNT_COLUMNS = {
    "hopital": "nb_hopitaux",
    "medecin": "nb_medecins",
    "dentiste": "nb_dentistes",
}

# Coarse grid for the region of a point when no polygon is known.
# Open box, then columns (upper longitude, [(lower latitude, region), ...], else region).
GRID_BOX = Box(48.815, 48.905, 2.255, 2.420)
GRID_COLUMNS = (
    (2.330, ((48.855, 16),), 15),
    (2.350, ((48.880, 17), (48.860, 8), (48.840, 7)), 14),
    (2.365, ((48.875, 9), (48.855, 1), (48.835, 6)), 13),
    (2.380, ((48.875, 10), (48.855, 4), (48.835, 5)), 13),
    (2.395, ((48.875, 19), (48.860, 11), (48.840, 12)), 13),
    (None, ((48.875, 20), (48.855, 11)), 12),
)

# Default tables by region 1..20, used when a source is missing.
CENTRALITY = (10, 9.5, 9, 9.5, 8.5, 8.5, 8, 8, 7.5, 7, 7.5, 6.5, 6, 6, 6.5, 6, 7, 6.5, 5.5, 6)
DEFAULT_OFFENCES = (
    3200, 2100, 1800, 2400, 1500, 1600, 1200, 5800, 3900, 3500,
    4200, 2800, 2600, 2200, 2900, 1900, 2700, 5100, 3800, 3100,
)
DEFAULT_POLICE = (1, 1, 1, 1, 1, 1, 1, 1, 1, 2, 2, 2, 2, 1, 2, 2, 2, 2, 2, 2)
DEFAULT_FIRE = (0, 1, 1, 1, 1, 0, 1, 1, 0, 1, 2, 2, 2, 1, 3, 2, 2, 2, 1, 1)
DEFAULT_PRICES = (
    14000, 13000, 12500, 13500, 13000, 15000, 14500, 13500, 11000, 10500,
    10500, 10000, 9500, 10000, 10500, 12000, 11500, 10000, 9000, 9500,
)
DEFAULT_TRAFFIC_SCORES = (
    2.8, 2.2, 3.5, 3.2, 4.2, 4.0, 5.0, 1.2, 1.8, 2.1,
    3.0, 3.8, 3.5, 4.0, 3.0, 4.5, 2.8, 3.2, 4.0, 4.2,
)
# Reference air readings by region: index, NO2, PM2.5.
# Reference readings by region, in region order.
AIR_INDEX_BASE = (52, 54, 50, 51, 48, 47, 45, 58, 56, 55, 53, 49, 51, 47, 48, 44, 53, 62, 64, 60)
AIR_NO2_BASE = (38, 40, 36, 37, 34, 33, 31, 44, 42, 41, 39, 35, 37, 33, 34, 30, 39, 48, 50, 46)
AIR_PM25_BASE = (12, 13, 11, 12, 10, 10, 9, 14, 13, 13, 12, 11, 12, 10, 10, 9, 12, 16, 17, 15)


def by_region(values) -> dict[int, float]:
    """Region code -> value for a default table written in region order."""
    return {i: float(v) for i, v in enumerate(values, start=1)}


@dataclass(frozen=True)
class ScoreWeights:
    """Weights of the composite scores (fixed values)."""

    access: dict = field(
        default_factory=lambda: {
            "transport": 0.40, "schools": 0.15, "shops": 0.20, "health": 0.15, "centrality": 0.10,
        }
    )
    life: dict = field(
        default_factory=lambda: {"parks": 0.30, "air": 0.25, "noise": 0.25, "traffic": 0.20}
    )
    safety: dict = field(
        default_factory=lambda: {"crime": 0.60, "police": 0.25, "fire": 0.15}
    )
    housing: dict = field(default_factory=lambda: {"purchase": 0.6, "effort": 0.4})
    neutral: float = 5.0
    rent_surface: float = 50.0


# Air alert thresholds (strict) and level names.
ALERT_ORANGE = 75.0
ALERT_RED = 100.0
LEVEL_ORANGE = "orange"
LEVEL_RED = "rouge"

# Category keywords, first matching category wins.
CATEGORY_KEYWORDS = (
    ("accessibilite", ("transport", "metro", "rer", "bus", "acces")),
    ("qualite_vie", ("air", "bruit", "parc", "jardin", "pollution", "circulation")),
    ("securite", ("crim", "delit", "incident", "securite")),
    ("economique", ("prix", "loyer", "revenu", "ls", "social")),
)
CATEGORY_OTHER = "autre"

# Alias -> substrings, in lookup order, per reference file.
SOCIAL_ALIASES = (
    ("arrondissement", ("arrondissement", "arr")),
    ("code_postal", ("code_postal", "cp", "postal")),
    ("part_logements_sociaux_pct", ("part_ls_pct", "part_ls", "part")),
    ("nb_logements_sociaux", ("nb_logements_sociaux", "nb_log", "nb")),
    ("annee", ("annee", "year", "an")),
)
INCOME_ALIASES = (
    ("revenu_median", ("q2", "med", "median", "revenu_median")),
    ("revenu_d1", ("d1", "decile1", "premier_decile")),
    ("revenu_d9", ("d9", "decile9", "neuvieme_decile")),
    ("taux_pauvrete", ("taux_pauv", "tp", "pauvrete")),
    ("gini", ("gini",)),
)
INCOME_CODE_COLUMNS = ("codgeo", "code_commune", "com", "depcom")
RENT_ALIASES = (
    ("arrondissement", ("arr", "arrondissement")),
    ("nb_pieces", ("piece", "nb_pieces", "npi")),
    ("loyer_max_m2", ("ref_majore", "loyer_max", "plafond")),
    ("loyer_min_m2", ("ref_minoree", "loyer_min", "plancher")),
    ("loyer_ref_m2", ("reference", "loyer_ref", "loyer_med")),
    ("epoque_construction", ("epoque", "periode", "construction")),
    ("meuble", ("meuble", "type_loc")),
)

# Limits of the serving functions.
RADIUS_BOUNDS_M = (10, 5000)
RADIUS_TOP = 200
INVENTORY_LIMIT = (1, 100)
EVENT_LIMIT = (1, 500)
WINDOW_HOURS = (1, 168)
RETENTION_DAYS = 30
LOW_VOLUME = 10
MIN_OUTLIER_ROWS = 5

# Source -> (label, provider, description) of the data catalog.
CATALOG_ENTRIES = (
    ("dvf", "Demandes de Valeurs Foncières", "data.gouv.fr / DGFiP",
     "Transactions immobilières 2021-2024, prix au m²"),
    ("geo_arrondissements.geojson", "Contours arrondissements", "OpenData Paris",
     "Géométries des 20 arrondissements (4326)"),
    ("logements_sociaux_paris.csv", "Logements sociaux RPLS", "data.gouv.fr",
     "Parc social bailleurs sociaux"),
    ("revenus_insee_paris.csv", "Revenus INSEE Filosofi", "INSEE",
     "Revenus médian par commune/IRIS"),
    ("loyers_reference_paris.csv", "Encadrement des loyers", "OpenData Paris",
     "Loyers de référence par quartier"),
    ("transports_idf_arrets.json", "Arrêts IDFM", "Île-de-France Mobilités",
     "Gares & arrêts Métro/RER/Bus"),
    ("education_paris.json", "Annuaire de l'éducation", "data.education.gouv.fr",
     "Écoles, collèges, lycées"),
    ("commerces_paris.json", "Commerces OSM", "OpenStreetMap Overpass",
     "Supermarchés, boulangeries, pharmacies"),
    ("sante_paris.json", "Établissements de santé OSM", "OpenStreetMap Overpass",
     "Hôpitaux, cliniques, médecins"),
    ("parcs_paris_osm.json", "Parcs et jardins OSM", "OpenStreetMap Overpass",
     "Espaces verts publics"),
    ("qualite_air_paris.json", "Qualité de l'air", "AIRPARIF", "Indices NO2, PM10, PM2.5"),
    ("bruit_paris.json", "Bruit", "OpenData Paris", "Cartographie sonore"),
    ("circulation_paris.json", "Circulation", "OpenData Paris", "Comptages routiers temps réel"),
    ("criminalite_paris.csv", "Délinquance enregistrée", "SSMSI / Intérieur",
     "Faits constatés par commune et catégorie"),
)
UNKNOWN_PROVIDER = "inconnu"

# Size limits of a broadcast side, in rows. Every explicit broadcast counts first.
BROADCAST_ROWS = 200_000
# And in bytes, where rows hold arrays.
BROADCAST_BYTES = 64 << 20
