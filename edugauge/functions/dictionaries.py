"""Business dictionaries."""

# State -> macro-region.
STATE_REGIONS = {
    "AC": "Norte", "AP": "Norte", "AM": "Norte", "PA": "Norte", "RO": "Norte", "RR": "Norte",
    "TO": "Norte",
    "AL": "Nordeste", "BA": "Nordeste", "CE": "Nordeste", "MA": "Nordeste", "PB": "Nordeste",
    "PE": "Nordeste", "PI": "Nordeste", "RN": "Nordeste", "SE": "Nordeste",
    "DF": "Centro-Oeste", "GO": "Centro-Oeste", "MT": "Centro-Oeste", "MS": "Centro-Oeste",
    "ES": "Sudeste", "MG": "Sudeste", "RJ": "Sudeste", "SP": "Sudeste",
    "PR": "Sul", "RS": "Sul", "SC": "Sul",
}

# State -> official numeric code.
STATE_CODES = {
    "RO": 11, "AC": 12, "AM": 13, "RR": 14, "PA": 15, "AP": 16, "TO": 17,
    "MA": 21, "PI": 22, "CE": 23, "RN": 24, "PB": 25, "PE": 26, "AL": 27, "SE": 28, "BA": 29,
    "MG": 31, "ES": 32, "RJ": 33, "SP": 35,
    "PR": 41, "SC": 42, "RS": 43,
    "MS": 50, "MT": 51, "GO": 52, "DF": 53,
}

# Administrative dependency of a school, and network of an aggregate row.
DEPENDENCY_NAMES = {1: "Federal", 2: "Estadual", 3: "Municipal", 4: "Privada"}
NETWORK_NAMES = {
    0: "Total",
    2: "Estadual",
    3: "Municipal",
    4: "Privada",
    5: "Total (Estadual+Municipal)",
}

# Grade and literacy texts.
GRADE_NAMES = {2: "2º Ano do Ensino Fundamental"}
YES_NO_NAMES = {1: "Sim", 0: "Não"}

# Right-closed bands (upper edges, labels).
SCORE_BANDS = ([649.99, 699.99, 742.99, 799.99], ["< 650", "650-699", "700-742", "743-799", "800+"])
MEAN_BANDS = ([699.99, 742.99, 799.99], ["< 700", "700-742", "743-799", "800+"])
LITERACY_BANDS = ([39.99, 59.99, 79.99], ["Muito Baixa", "Baixa", "Boa", "Excelente"])

# Descending thresholds and their labels.
LEVEL_THRESHOLDS = [(80, "Nível 5"), (70, "Nível 4"), (60, "Nível 3"), (50, "Nível 2"), (40, "Nível 1")]
LEVEL_DEFAULT = "Abaixo do Nível 1"
LEVEL_ORDER = {
    "Abaixo do Nível 1": 0, "Nível 1": 1, "Nível 2": 2, "Nível 3": 3, "Nível 4": 4, "Nível 5": 5,
}
RELATIVE_THRESHOLDS = [(30, "Muito Acima"), (10, "Acima"), (-10, "Na Média"), (-30, "Abaixo")]
RELATIVE_DEFAULT = "Muito Abaixo"

# Assessment years, goal years, literacy cut, default goal.
ASSESSMENT_YEARS = [2023, 2024, 2025]
GOAL_YEARS = [2024, 2025, 2026, 2027, 2028, 2029, 2030]
LITERACY_CUT = 743.0
DEFAULT_GOAL = 80.0
