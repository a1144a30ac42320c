"""Word lists, lookup tables and thresholds.

Everything in this module is data whose exact value decides results; the logic
that uses it lives in ``clipcatalog.functions``.
"""

# --- fixed values: creators whose captions earn a small score bonus ----------
KNOWN_CREATORS = [
    "thegoldenbalance", "cjeatsrecipes", "fitwaffle", "wishbonekitchen",
    "tinekeyounger", "the_pastaqueen", "louloukitchen", "hervecuisine",
    "marmiton_org", "kiwilimon", "chefjosera", "giallozafferano",
    "fattoincasadabenedetta", "cucinabotanica", "tastemadebr", "panelinha",
    "receiteria",
]

# --- fixed values: scoring vocabularies -------------------------------------
RECIPE_HASHTAGS = [
    "recipe", "recipes", "recipesoftiktok", "easyrecipe", "foodtok", "mealprep",
    "healthyrecipes", "dinnerideas", "recette", "recettesfaciles", "receta",
    "recetasfaciles", "ricetta", "ricettefacili", "receita", "receitasfaceis",
]
RECIPE_WORDS = [
    "recipe", "how to make", "ingredients", "full recipe", "recipe below",
    "recette", "ingredients en description", "receta", "ingredientes",
    "ricetta", "ingredienti", "receita", "ingredientes", "وصفة", "مكونات",
]
INGREDIENT_WORDS = [
    "flour", "sugar", "butter", "egg", "chicken", "garlic", "onion", "cheese",
    "pasta", "rice", "tomato", "huile", "beurre", "oeuf", "poulet", "farine",
    "azucar", "mantequilla", "pollo", "farina", "burro", "uovo", "frango",
    "farinha",
]
COOKING_VERBS = [
    "mix", "stir", "bake", "cook", "fry", "boil", "chop", "blend", "roast",
    "season", "add", "melt", "mijoter", "melanger", "ajouter", "cuire",
    "couper", "mezclar", "cocinar", "hornear", "freir", "aggiungere",
    "cuocere", "mescolare", "assar", "cozinhar", "misturar",
]
QUANTITY_UNITS = (
    "g|kg|ml|l|tbsp|tsp|cup|cups|oz|lb|lbs|min|minutes|h|hour|hours"
)
TEMPERATURE_UNITS = "c|f|°c|°f"

# --- fixed values: caption signals -------------------------------------------
RECIPE_SIGNALS = [
    "recipe", "recipes", "ingredient", "ingredients", "how to make", "cook",
    "cooking", "bake", "meal prep", "dinner", "lunch", "breakfast", "recette",
    "ingrédient", "ingredients", "cuisine", "receta", "ingredientes", "cocina",
    "ricetta", "ingredienti", "cucina", "receita", "ingredientes", "cozinha",
    "وصفة", "وصفات", "مكونات", "طبخ",
]
SIGNAL_HASHTAGS = [
    "recipe", "recipesoftiktok", "easyrecipe", "foodtok", "cooking", "mealprep",
    "healthyrecipes", "dinnerideas", "recette", "recettesfaciles", "cuisine",
    "receta", "recetasfaciles", "cocina", "ricetta", "ricettefacili", "receita",
    "receitasfaceis", "وصفات", "طبخ",
]
COMMENT_SIGNALS = [
    "recipe", "ingredients", "ingredient", "cups", "tbsp", "tsp", "grams",
    "recette", "ingredients", "receta", "ingredientes", "ricetta",
    "ingredienti", "receita", "ingredientes", "مكونات", "وصفة",
]

# --- fixed values: language markers, first match wins -------------------------
CAPTION_LANGUAGE_MARKERS = [
    ("fr", ["recette", "recettes", "cuisine", "poulet", "pates", "ingrédients", "ingredients"]),
    ("es", ["receta", "recetas", "cocina", "ingredientes", "pollo", "comida"]),
    ("it", ["ricetta", "ricette", "cucina", "ingredienti", "pollo", "pasta"]),
    ("pt", ["receita", "receitas", "cozinha", "ingredientes", "frango"]),
    ("ar", ["وصفة", "وصفات", "طبخ", "مكونات"]),
]
SEED_LANGUAGE_MARKERS = [
    ("es", ["receta", "ingredientes", "albondigas", "pápalo"]),
    ("fr", ["recette", "ingrédients", "poulet", "crème"]),
    ("it", ["ricetta", "ingredienti", "burro", "pasta fresca"]),
]

# --- fixed values: language names ---------------------------------------------
LANGUAGE_CODES = ["en", "fr", "es", "it", "pt", "ar"]
STAGING_LANGUAGE_ALIASES = {
    "english": "en", "eng": "en",
    "french": "fr", "francais": "fr",
    "spanish": "es", "espanol": "es",
    "italian": "it", "italiano": "it",
    "portuguese": "pt", "portugues": "pt",
    "arabic": "ar",
}
ANSWER_LANGUAGE_ALIASES = {
    "english": "en", "eng": "en",
    "french": "fr", "français": "fr", "francais": "fr",
    "spanish": "es", "español": "es",
    "italian": "it", "italiano": "it",
    "portuguese": "pt", "portugues": "pt", "português": "pt",
    "arabic": "ar", "العربية": "ar",
}
LANGUAGE_LABELS = {
    "en": "English", "fr": "French", "it": "Italian",
    "es": "Spanish", "pt": "Portuguese", "ar": "Arabic",
}

# --- fixed values: boolean spellings -------------------------------------------
WAREHOUSE_TRUE = ["true", "t", "yes", "y", "on", "1"]
WAREHOUSE_FALSE = ["false", "f", "no", "n", "off", "0"]
ANSWER_TRUE = ["true", "yes", "y", "1", "vegetarian", "veg", "végétarien"]
ANSWER_FALSE = ["false", "no", "n", "0", "non-vegetarian", "non vegetarian", "not vegetarian"]

# --- fixed values: placeholders -------------------------------------------------
LIST_PLACEHOLDERS = ["unknown", "none", "n/a", "null"]
BLANK_LIST_TEXTS = ["null", "none", "unknown", "[]"]
INGREDIENT_PLACEHOLDERS = ["unknown", "none", "null", "ingredient"]
SECTION_LABELS = [
    "ingredients", "ingredient", "steps", "instructions", "preparation",
    "method", "directions",
]
INGREDIENT_NOISE_WORDS = (
    "g|kg|ml|cl|l|tbsp|tsp|cup|cups|cuil|cuillere|cuillère|soupe|sachet|pincée|"
    "pincee|de|d'|du|des|fresh|frais|fondu|fondue|tiède|tiede"
)
CAPTION_BOILERPLATE = [
    "tiktok video", "watch the latest videos", "discover videos related",
    "log in to follow creators",
]
CAPTION_JSON_KEYS = ["desc", "description", "title", "caption"]
CAPTION_ID_KEYS = ["id", "itemId", "aweme_id", "video_id"]
CSV_NULL_TOKENS = ["", "NULL", "null"]

# --- fixed values: statuses -------------------------------------------------------
RECIPE_STATUSES = ["full_recipe", "partial_recipe", "food_content", "non_recipe"]
PUBLISHED_STATUSES = ["full_recipe", "partial_recipe"]
WEAK_STATUSES = ["partial_recipe", "food_content", "unknown"]
SUCCESS_STATUSES = ["attempted_success", "technical_success", "usable_recipe_text"]
RETRY_BLOCKING_STATUSES = [
    "attempted_failed", "attempted_empty", "rejected_gibberish", "technical_success",
]
EVIDENCE_SOURCE_TYPES = [
    "caption_original", "web_metadata", "oembed", "browser_dom", "video_ocr",
    "audio_transcript", "hashtags", "creator_context", "comments", "external_url",
]
SOURCE_TYPE_BY_METHOD = {
    "web_caption": "web_metadata",
    "comments": "comments",
    "external_url": "external_url",
    "audio_transcript": "audio_transcript",
    "ocr": "video_ocr",
}
METHOD_ORDER = ["web_caption", "audio_transcript", "ocr", "external_url", "comments"]

# --- fixed values: (confidence with recipe signal, without) per method --------------
BASE_CONFIDENCE = {
    "web_caption": (0.65, 0.45),
    "external_url": (0.75, 0.45),
    "comments": (0.65, 0.35),
    "ocr": (0.60, 0.35),
}

# --- fixed values: score thresholds ---------------------------------------------------
EVIDENCE_CLASS_EDGES = [(0.70, "high"), (0.45, "medium"), (0.20, "low")]
QUALITY_GRADE_EDGES = [(0.80, "A"), (0.60, "B"), (0.40, "C")]

# --- fixed values: text limits ----------------------------------------------------------
TITLE_CHARS = 120
PREVIEW_CHARS = 130
PIECES_CHARS = 10_000
PAGE_CHARS = 8_000
EVIDENCE_SEPARATOR = "\n\n---\n\n"

# --- fixed values: default creator list of the vocabulary loader ---------------------------
DEFAULT_CREATORS = KNOWN_CREATORS
