"""Schemas of the landed files and of the public tables (DDL strings).

Scalars of landed JSON are read as strings, because sources switch between numbers
and quoted numbers; the silver jobs cast them.
"""

SALES_COLUMNS = (
    "date_mutation", "nature_mutation", "valeur_fonciere", "code_postal", "type_local",
    "surface_reelle_bati", "nombre_pieces_principales", "longitude", "latitude",
)

POINT = "struct<lat: string, lon: string, latitude: string, longitude: string>"

STOP = (
    "nom_long string, stop_name string, nom_arret string, nom string, "
    f"geo_point_2d {POINT}, stop_lat string, stop_lon string, latitude string, longitude string, "
    "x string, y string, type_transport string, mode string"
)
SCHOOL = (
    "code_postal_uai string, code_postal string, latitude string, lat string, longitude string, "
    f"lon string, position {POINT}, geo_point_2d {POINT}, nom_etablissement string, "
    "appellation_officielle string, type_etablissement string, statut_public_prive string"
)


def envelope(record: str) -> str:
    """A bare record, or records wrapped in ``results`` or ``records``."""
    nested = ", ".join(_fields(record))
    return f"{record}, results array<struct<{nested}>>, records array<struct<{nested}>>"


def _fields(ddl: str) -> list[str]:
    """``name type`` pairs of a DDL string as ``name: type``, nested types left whole."""
    out, depth, start = [], 0, 0
    for i, ch in enumerate(ddl + ","):
        depth += ch in "<("
        depth -= ch in ">)"
        if ch == "," and depth == 0:
            name, kind = ddl[start:i].strip().split(" ", 1)
            out.append(f"{name}: {kind}")
            start = i + 1
    return out


ELEMENTS = (
    "elements array<struct<type: string, id: bigint, lat: double, lon: double, "
    "center: struct<lat: double, lon: double>, tags: map<string, string>>>"
)

AIR = (
    "source string, arrondissements map<string, struct<iqa_moyen: double, `no2_µg_m3`: double, "
    "`pm25_µg_m3`: double>>, commune_code string, insee string, indice string, iqa string, "
    "no2 string, pm25 string, pm2_5 string"
)
NOISE = (
    "source string, arrondissements map<string, struct<lden_moyen: double, lden_route: double, "
    "lnight: double, score_bruit: double>>, records array<struct<fields: struct<commune_code: string, "
    "lden: string, laeq: string, lnight: string, ln: string>>>"
)
TRAFFIC = (
    "source string, arrondissements map<string, struct<tmja_moyen: double, indice_congestion: double, "
    "score_circulation: double>>, records array<struct<arrondissement: string, arr: string, "
    "code_arr: string, codearr: string, q: string, debit: string, tmja: string, "
    "debit_moyen_journalier: string>>"
)
SHOPS = (
    "source string, arrondissements map<string, struct<supermarches: bigint, pharmacies: bigint, "
    f"boulangeries: bigint, centres_commerciaux: bigint>>, {ELEMENTS}"
)
HEALTH = (
    "source string, arrondissements map<string, struct<hopitaux: bigint, medecins: bigint, "
    f"dentistes: bigint>>, {ELEMENTS}"
)
GEO = (
    "type string, features array<struct<properties: map<string, string>, "
    "geometry: struct<type: string, coordinates: string>>>"
)

# Stream records.
STREAM_BATCH = (
    "batch_id int, timestamp timestamp, arrondissement int, type_local string, surface_m2 double, "
    "prix_m2 double, valeur double"
)
AIR_EVENT = (
    "type string, source string, ingested_at timestamp, timestamp timestamp, arrondissement int, "
    "iqa double, `no2_µg_m3` double, `pm25_µg_m3` double, alert_level string, iqa_24h_mean double"
)
