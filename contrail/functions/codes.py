"""Code maps and constants.

Fixed values: these must equal the reference's values for results to
match, so they are stated plainly here, in the reference's order.
"""

from __future__ import annotations

# ---- fixed values -------------------------------------------------------
# airline ICAO code -> (name, country); anything else is Unknown Airline / UN
AIRLINES = [
    ("AVA", "Avianca", "CO"),
    ("DAL", "Delta Air Lines", "US"),
    ("UAL", "United Airlines", "US"),
    ("AAL", "American Airlines", "US"),
    ("IBE", "Iberia", "ES"),
    ("AFR", "Air France", "FR"),
    ("KLM", "KLM", "NL"),
    ("BAW", "British Airways", "GB"),
    ("CMP", "Copa Airlines", "PA"),
    ("JBU", "JetBlue", "US"),
    ("QTR", "Qatar Airways", "QA"),
    ("ACA", "Air Canada", "CA"),
    ("SWA", "Southwest Airlines", "US"),
    ("VOI", "Volaris", "MX"),
    ("JAL", "Japan Airlines", "JP"),
]
UNKNOWN_AIRLINE = ("Unknown Airline", "UN")

# seat configuration JSON documents
SEAT_MAPS = [
    '{"economy": 180}',
    '{"business": 16, "economy": 150}',
    '{"business": 24, "economy": 220}',
    '{"business": 30, "economy": 260}',
]

# holidays MM-DD -> name
HOLIDAYS = [
    ("01-01", "Año Nuevo"),
    ("05-01", "Día del Trabajo"),
    ("07-04", "Independencia USA"),
    ("09-15", "Independencia Costa Rica"),
    ("11-28", "Independencia Panamá"),
    ("12-24", "Nochebuena"),
    ("12-25", "Navidad"),
    ("12-31", "Fin de Año"),
]
SEASON_HIGH_MONTHS = [6, 7, 8, 12]
SEASON_MID_MONTHS = [3, 4, 5, 9, 10, 11]

# continent -> region name (else NORTEAMERICA)
CONTINENT_REGION = [("NA", "NORTEAMERICA"), ("SA", "SUDAMERICA"), ("EU", "EUROPA"),
                    ("AS", "ASIA"), ("AF", "AFRICA"), ("OC", "OCEANIA")]
# country -> time zone (else UTC)
COUNTRY_TZ = [("US", "America/New_York"), ("CR", "America/Costa_Rica"),
              ("MX", "America/Mexico_City"), ("ES", "Europe/Madrid"),
              ("GB", "Europe/London"), ("FR", "Europe/Paris"),
              ("DE", "Europe/Berlin"), ("BR", "America/Sao_Paulo")]

# maintenance action -> check type; duration hours; cost base + spread
ACTION_CHECK = [("INSPECTION", "A"), ("CLEANING", "LINE"), ("TEST", "LINE"),
                ("REPAIR", "B"), ("REPLACEMENT", "C"), ("OVERHAUL", "D")]
ACTION_HOURS = [("CLEANING", 2), ("TEST", 4), ("INSPECTION", 8), ("REPAIR", 24),
                ("REPLACEMENT", 48), ("OVERHAUL", 120)]
ACTION_HOURS_DEFAULT = 4

# baggage event -> state (unknown / null -> CHECKED)
BAG_EVENT_STATE = [("CHECKIN", "CHECKED"), ("LOAD", "LOADED"), ("UNLOAD", "UNLOADED")]
BAG_STATE_DEFAULT = "CHECKED"

# crew role spelling -> role (unknown / null -> FA)
CREW_ROLE_MAP = [("FIRST_OFFICER", "FO"), ("RELIEF_PILOT", "RELIEF_CAPTAIN"),
                 ("CABIN_CREW", "FA")]
CREW_ROLES_KEPT = ["CAPTAIN", "FO", "RELIEF_CAPTAIN", "PURSER", "FA", "LOADMASTER"]
CREW_ROLE_DEFAULT = "FA"

# crew roles: id, role, type, min rest hours, max duty hours
CREW_ROLE_DIM = [
    (1, "CAPTAIN", "COCKPIT", 12, 13),
    (2, "FO", "COCKPIT", 12, 13),
    (3, "RELIEF_CAPTAIN", "COCKPIT", 12, 16),
    (4, "PURSER", "CABIN", 10, 14),
    (5, "FA", "CABIN", 10, 14),
    (6, "LOADMASTER", "CABIN", 10, 12),
]

# cargo types kept; others become GENERAL
CARGO_TYPES = ["GENERAL", "PERECIBLE", "PELIGROSA", "VALORADA", "ANIMALES"]
# cargo yield rate USD/kg (else 2.44)
CARGO_YIELD_RATE = [("GENERAL", "2.50"), ("PERECIBLE", "4.50"), ("PELIGROSA", "6.50"),
                    ("VALORADA", "10.00"), ("ANIMALES", "7.50")]
CARGO_YIELD_DEFAULT = "2.44"

# passenger class code -> category
CLASS_CATEGORY = [("F", "FIRST"), ("J", "FIRST"), ("C", "BUSINESS"), ("W", "BUSINESS")]
CLASS_DEFAULT = "ECONOMY"

# passenger segment and frequency
BUSINESS_CATEGORIES = ["FIRST", "PREMIUM", "PLATINUM", "DIAMOND", "GOLD", "EXEC"]

# per diem USD/h base + spread by crew role (else 12 + 6)
PER_DIEM = [("CAPTAIN", 25, 15), ("FO", 18, 10), ("RELIEF_CAPTAIN", 22, 13),
            ("PURSER", 15, 8), ("FA", 12, 6), ("LOADMASTER", 14, 7)]

# flight phase thresholds are written inline in conform.flight_phase

CO2_PER_KG_FUEL = 3.16
ON_TIME_MINUTES = 15
FT_TO_M = 0.3048
M_PER_NM = 1852.0
M_PER_KM = 1000.0
EARTH_RADIUS_SPHERE_M = 6371008.771415
WGS84_A = 6378137.0
WGS84_F = 1 / 298.257223563
# ---- end of fixed values ------------------------------------------------

# Fixture-only code lists (our own, not reference values)
NATION_CODES = ["US", "CR", "MX", "ES", "GB", "FR", "DE", "BR"]
REGION_CONTINENT = ["NA", "SA", "EU", "AS", "AF"]
AIRCRAFT_TYPES = ["Airbus A320", "B737-800", "Airbus A330", "B787-9", "E190"]
