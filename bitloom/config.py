"""Patterns, term lists, thresholds and templates.

Everything in this file is data. The lists below are fixed values: results only agree with the
published behaviour when they hold exactly these entries.
"""

from __future__ import annotations

from dataclasses import dataclass

# --- Fixed values: placeholder patterns of the preprocessing pipeline, in order -----------------
PIPELINE_PATTERNS = [
    (r"\{(\d+)\}", "__PLACEHOLDER_NUM_#__"),
    (r"\{([^}]+)\}", "__PLACEHOLDER_VAR_#__"),
    (r"%([sd%])", "__PERCENT_#__"),
    (r"\$\{([^}]+)\}", "__DOLLAR_VAR_#__"),
    (r"\\n", "__NEWLINE__"),
    (r"\\t", "__TAB__"),
]

# --- Fixed values: placeholder patterns of the guarded translation step, in order ---------------
GUARD_PATTERNS = [
    (r"\{(\d+)\}", "__PLACEHOLDER_NUM_#__"),
    (r"\{([a-zA-Z_][a-zA-Z0-9_]*)\}", "__PLACEHOLDER_VAR_#__"),
    (r"%([sd%])", "__PERCENT_VAR_#__"),
    (r"\$\{([^}]+)\}", "__DOLLAR_VAR_#__"),
]

# --- Fixed values: placeholders as counted by statistics, features and error checks -------------
BRACE_PLACEHOLDER = r"\{[^}]+\}"
PERCENT_PLACEHOLDER = r"%[sd%]"
NUMBERED_PLACEHOLDER = r"\{(\d+)\}"

# --- Fixed values: brand names with their token, matched without regard to case -----------------
BRAND_TOKENS = [
    ("TurboPower™", "__TURBOPOWER_TM__"),
    ("Ready For", "__READY_FOR__"),
    ("Family Space", "__FAMILY_SPACE__"),
    ("Experience hub", "__EXPERIENCE_HUB__"),
]

# --- Fixed values: terms whose presence flags a text as technical (lower-cased substrings). -----
DOMAIN_FLAG_TERMS = [
    "usb", "usb-c", "hdmi", "bluetooth", "wi-fi", "wifi", "ptt", "lpddr5", "ufs", "turbopower",
    "ready for", "emm", "pc", "ai", "ml", "nlp", "api", "sdk", "android", "ios", "windows",
    "linux", "macos", "chrome", "firefox", "safari", "edge", "motorola", "moto", "verizon", "google",
    "samsung",
]

# --- Fixed values: terms listed per pair by feature extraction (lower-cased substrings) ---------
FEATURE_TERMS = [
    "usb", "usb-c", "hdmi", "bluetooth", "wifi", "wi-fi",
    "ptt", "lpddr5", "ufs", "turbopower", "ready for",
    "emm", "pc", "ai", "ml", "nlp", "api", "sdk",
    "android", "ios", "windows", "linux", "macos",
    "app", "apps", "phone", "tablet", "device", "display",
    "battery", "screen", "notification", "settings", "permission",
]

# --- Fixed values: brand flag of feature extraction (case-sensitive substrings) -----------------
FEATURE_BRANDS = ["TurboPower", "Ready For", "Moto", "Motorola"]

# --- Fixed values: word stems of the dataset statistics -----------------------------------------
DOMAIN_STEMS = ["usb", "bluetooth", "wifi", "app", "phone", "display", "battery"]

# --- Fixed values: terms that must survive translation (quality check) --------------------------
PRESERVED_TERMS = ["USB", "USB-C", "HDMI", "Bluetooth", "Wi-Fi", "WiFi", "LPDDR5", "UFS"]

# --- Fixed values: terms replaced by tokens before a translation call ---------------------------
PROTECTED_TERMS = [
    "USB", "USB-C", "HDMI", "Bluetooth", "Wi-Fi", "WiFi",
    "LPDDR5", "UFS", "TurboPower™", "Ready For",
    "Moto", "Motorola", "Android", "iOS", "Windows",
    "PTT", "EMM", "SDK", "API", "NLP", "ML", "AI",
    "4G", "5G", "LTE", "NFC", "GPS", "OLED", "LCD",
]

# --- Fixed values: English function words that mark untranslated output -------------------------
UNTRANSLATED_WORDS = [
    "the", "is", "are", "was", "were", "be", "been", "being",
    "have", "has", "had", "do", "does", "did",
]

# --- Fixed values: sentence ends accepted by the fluency check ----------------------------------
SENTENCE_ENDS = [".", "!", "?", '"', "'"]

# --- Fixed values: English to Dutch glossary ----------------------------------------------------
GLOSSARY_EN_NL = {
    "settings": "instellingen", "permission": "toestemming", "permissions": "machtigingen",
    "device": "apparaat", "devices": "apparaten", "screen": "scherm", "display": "display",
    "battery": "accu", "notification": "melding", "notifications": "meldingen",
    "account": "account", "password": "wachtwoord", "username": "gebruikersnaam",
    "download": "downloaden", "upload": "uploaden", "file": "bestand", "files": "bestanden",
    "folder": "map", "app": "app", "application": "applicatie", "update": "update",
    "upgrade": "upgrade", "install": "installeren", "uninstall": "verwijderen",
    "sync": "synchroniseren", "backup": "back-up", "restore": "herstellen",
    "connect": "verbinden", "disconnect": "verbinding verbreken", "wireless": "draadloos",
    "cable": "kabel", "charging": "opladen", "power": "energie", "mode": "modus",
    "gesture": "gebaar", "swipe": "vegen", "tap": "tikken", "hold": "ingedrukt houden",
    "drag": "slepen", "drop": "neerzetten",
}

# --- Fixed values: word dictionary of the fallback translation ----------------------------------
FALLBACK_WORDS = {
    "settings": "instellingen", "device": "apparaat", "battery": "accu", "display": "display",
    "notification": "melding", "app": "app", "phone": "telefoon", "tablet": "tablet",
    "PC": "pc", "update": "update",
}
FALLBACK_TEXT = "[Translation unavailable]"

# --- Fixed values: instruction templates --------------------------------------------------------
PROMPT_TEMPLATES = {
    "llama": "<s>[INST] Translate the following English text to Dutch:\n{source} [/INST] {target}</s>",
    "mistral": "<s>[INST] Translate the following English text to Dutch:\n{source} [/INST] {target}</s>",
    "phi": "Instruct: Translate the following English text to Dutch:\n{source}\nOutput: {target}",
    "gpt2": "Translate English to Dutch:\nEnglish: {source}\nDutch: {target}",
    "generic": "### Instruction: Translate the following English text to Dutch.\n"
               "### Input: {source}\n### Response: {target}",
}

# --- Fixed values: response markers (start, optional end), tried in order -----------------------
RESPONSE_MARKERS = [("### Response:", None), ("[/INST]", "</s>"), ("Output:", None), ("Dutch:", None)]

# --- Fixed values: texts of warnings, issues and suggestions ------------------------------------
WARN_EMPTY = "Empty or whitespace-only input"
WARN_UTF8 = "Input contains invalid UTF-8 characters"
WARN_NUL = "Input contains null characters"
WARN_SPECIAL = "Input has high ratio of special characters"
SUGGEST_RETRANSLATE = "Consider retranslating this segment"
SUGGEST_BY_ERROR = {
    "length_mismatch": "Review for completeness - length differs significantly from source",
    "missing_placeholder": "Ensure all placeholders ({1}, {2}, etc.) are preserved",
    "untranslated": "Check for untranslated words",
}
SUGGEST_BY_CATEGORY = {
    "fluency": "Improve naturalness and readability",
    "accuracy": "Verify semantic accuracy against source",
    "terminology": "Review domain-specific terminology",
    "formatting": "Check formatting and placeholder preservation",
}
ERROR_TYPES = ["length_mismatch", "missing_placeholder", "untranslated", "semantic_divergence"]
REJECT_REASONS = ["empty", "too_short", "too_long", "mismatch"]

# --- Fixed values: weights of the aggregate score -----------------------------------------------
AGGREGATE_WEIGHTS = {"bleu": 1.0, "chrf_pp": 1.0, "comet": 2.0, "bert_score": 1.5, "ter": 0.5}


@dataclass(frozen=True)
class PreprocessConfig:
    """Switches of the preprocessing pipeline."""

    normalize_unicode: bool = True
    preserve_placeholders: bool = True
    preserve_technical_terms: bool = True
    strip_extra_whitespace: bool = True
    normalize_punctuation: bool = True
    fold_curly_quotes: bool = False
    max_length: int | None = None


@dataclass(frozen=True)
class LengthBounds:
    """Word bounds and target/source word-ratio bounds of the pair filter."""

    min_words: int = 5
    max_words: int = 200
    min_ratio: float = 0.3
    max_ratio: float = 3.0


CORPUS_SCRIPT_BOUNDS = LengthBounds(min_words=3, max_words=150)
