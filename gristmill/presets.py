"""Fixed values of the food-nutrition export: column spellings and plausible ranges."""

from __future__ import annotations

# The columns that name a product.
ID_COLUMNS = ["code", "product_name", "brands", "countries"]

# Accepted spellings per nutrient, first present one wins.
NUTRIENT_SYNONYMS = {
    "energy": ["energy_100g", "energy-kj_100g", "energy-kcal_100g"],
    "fat": ["fat_100g", "total-fat_100g"],
    "saturated_fat": ["saturated-fat_100g", "saturated_fat_100g"],
    "carbs": ["carbohydrates_100g", "carbs_100g"],
    "sugars": ["sugars_100g"],
    "fiber": ["fiber_100g", "dietary-fiber_100g", "dietary_fiber_100g"],
    "proteins": ["proteins_100g", "protein_100g"],
    "salt": ["salt_100g"],
    "sodium": ["sodium_100g"],
}

# The same, but a first look at a dump prefers kilocalories over kilojoules.
PROFILE_SYNONYMS = NUTRIENT_SYNONYMS | {
    "energy": ["energy-kcal_100g", "energy-kj_100g", "energy_100g"],
}

# Closed ranges per 100 g when preparing features (complete rows only).
FEATURE_BOUNDS = {
    "energy": (0.0, 8000.0),
    "fat": (0.0, 100.0),
    "saturated_fat": (0.0, 100.0),
    "carbs": (0.0, 100.0),
    "sugars": (0.0, 100.0),
    "fiber": (0.0, 100.0),
    "proteins": (0.0, 100.0),
    "salt": (0.0, 100.0),
    "sodium": (0.0, 40.0),
}

# The seven training columns and their ranges (partial rows are kept).
TRAINING_BOUNDS = {
    "energy_100g": (0.0, 4000.0),
    "proteins_100g": (0.0, 100.0),
    "fat_100g": (0.0, 100.0),
    "carbohydrates_100g": (0.0, 100.0),
    "sugars_100g": (0.0, 100.0),
    "fiber_100g": (0.0, 100.0),
    "salt_100g": (0.0, 100.0),
}
TRAINING_COLUMNS = list(TRAINING_BOUNDS)

# Sample size, seed, and the sizes of the two sweeps.
SAMPLE_TARGET = 200_000
SEED = 42
FULL_SWEEP = {"ks": range(3, 11), "max_iter": 50}
FAST_SWEEP = {"ks": range(3, 7), "max_iter": 20, "tol": 1e-3, "score_fraction": 0.15}
