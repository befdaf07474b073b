"""Names, cut points and word lists that results depend on."""

from __future__ import annotations

# --- fixed values: class names, tiers and markers ---------------------------
LABEL_NAMES = {0: "Flop", 1: "Rentable", 2: "Hit"}
TIER_NOVICE, TIER_ESTABLISHED, TIER_TOP = "Novato", "Establecido", "AAA"
UNKNOWN = "Desconocido"
PRICE_TIERS = ("F2P", "Budget", "Mid", "Premium")
QUARTERS = ("Q1", "Q2", "Q3", "Q4")
LEVEL_HIGH, LEVEL_MEDIUM, LEVEL_LOW = "alta", "media", "baja"
NO_TRACTION = "NoTraccion"

# --- fixed values: cut points ----------------------------------------------
FLOP_MAX_OWNERS = 200_000
HIT_MIN_OWNERS = 1_000_000
PRICE_CAP = 200.0
MODEL_PRICE_CAP = 70.0
PRIOR_STRENGTH = 12.0
NEAR_CONSTANT_SHARE = 0.999
REVIEW_START_EPOCH = 1_704_067_200
DEFAULT_PANEL_MONTH = "2024-01"
PRICE_BINS = (0, 5, 10, 15, 20, 30, 40, 60, 1e9)
PRICE_BIN_LABELS = ("F2P/<5", "5–10", "10–15", "15–20", "20–30", "30–40", "40–60", "60+")

# --- fixed values: column roles --------------------------------------------
ID_COLS = ("appid", "name", "developer", "publisher", "release_date")
LABEL_COLS = ("label", "label_name")
TARGET_COLS = ("owners_lower_bound", "ccu")
POSTLAUNCH_COLS = ("positive", "negative", "rating_porcentaje", "metacritic_score")
TEMPORAL_COLS = ("release_year", "release_month")
CATEGORICAL_COLS = ("dev_experience", "controller_support", "pub_experience", "price_tier", "release_quarter")
DERIVED_COLS = ("dev_game_count", "pub_game_count", "dev_success_prior", "num_genres", "num_tags", "num_categories")
FLAG_PREFIXES = ("genre_", "cat_", "tag_", "platform_", "is_")
# Roles of columns by name, by prefix and otherwise, and the stage at which a role is known.
ROLE_NAMES = (("id", ID_COLS), ("target_label", LABEL_COLS), ("target_raw", TARGET_COLS), ("outcome_postlaunch", POSTLAUNCH_COLS),
              ("analysis_temporal", TEMPORAL_COLS), ("feature_categorical", CATEGORICAL_COLS), ("feature_derived", DERIVED_COLS))
ROLE_PREFIXES = (("timeseries_postlaunch", ("ts_",)), ("feature_tag", FLAG_PREFIXES))
OTHER_ROLE = "feature_numeric"
ROLE_STAGES = {"feature_categorical": "pre", "feature_derived": "pre", "feature_tag": "pre", "feature_numeric": "pre",
               "outcome_postlaunch": "post", "timeseries_postlaunch": "post"}
# Derived features that are never offered as an explanation.
DERIVED_SKIP = ("num_genres", "num_tags", "num_categories", "price_tier")
STAGE1_NUMERIC = ("price", "supported_languages", "total_achievements", "total_dlcs", "min_ram_gb",
                  "short_desc_len", "dev_game_count", "pub_game_count", "num_genres", "num_tags", "num_categories")

# --- fixed values: multi-hot vocabularies ----------------------------------
GENRES = (
    "Action", "Adventure", "Casual", "Free to Play", "Indie", "Massively Multiplayer", "RPG", "Racing",
    "Simulation", "Sports", "Strategy", "Violent", "Gore", "Early Access",
)
CATEGORIES = (
    "Single-player", "Multi-player", "Co-op", "Online Co-op", "Local Co-op", "Full controller support",
    "Partial Controller Support", "Steam Achievements", "Steam Cloud", "Steam Workshop", "In-App Purchases",
    "Steam Trading Cards", "Remote Play Together", "Shared/Split Screen Co-op",
)
TAGS = (
    "Pixel Art", "First-Person", "Open World", "Crafting", "Permadeath", "Story Rich", "Roguelike", "Roguelite",
    "Survival", "Horror", "RPG", "Action RPG", "Turn-Based", "Strategy", "Tower Defense", "Platformer",
    "Metroidvania", "Soulslike", "Co-op", "Multiplayer", "Local Co-Op", "PvP", "Battle Royale", "Sandbox",
    "Simulation", "Management", "City Builder", "Sports", "Racing", "Puzzle", "Point & Click", "Visual Novel",
    "Anime", "2D", "3D", "Realistic", "Low Poly", "Cartoon", "Dark", "Atmospheric", "Relaxing", "Difficult",
    "Casual", "Indie", "Early Access", "Free to Play", "VR", "MOBA", "FPS", "Stealth",
)

# --- fixed values: display labels ------------------------------------------
ACRONYMS = ("rpg", "fps", "pvp", "vr", "2d", "3d", "moba")
NICE_LABELS = {
    "price": "Precio",
    "supported_languages": "Idiomas soportados",
    "total_achievements": "Logros",
    "total_dlcs": "DLCs",
    "min_ram_gb": "RAM mínima",
    "short_desc_len": "Longitud de la descripción",
    "dev_game_count": "Juegos previos del estudio",
    "pub_game_count": "Juegos previos del publisher",
    "dev_experience": "Experiencia del estudio",
    "pub_experience": "Experiencia del publisher",
    "controller_support": "Soporte de control",
    "release_quarter": "Trimestre de lanzamiento",
    "dev_success_prior": "Historial del estudio",
}


def slug(name: str) -> str:
    """Column-name form of a vocabulary entry: lower case, blanks, '-' and '/' to '_'."""
    return name.lower().translate(str.maketrans(" -/", "___"))


def flag_columns(prefix: str, vocabulary) -> list[str]:
    return [prefix + slug(v) for v in vocabulary]
