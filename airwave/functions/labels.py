"""Display labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Language code to display name.
LANGUAGE_NAMES = {
    "en": "English",
    "es": "Spanish",
    "pt": "Portuguese",
    "de": "German",
    "fr": "French",
    "ru": "Russian",
    "ja": "Japanese",
    "ko": "Korean",
    "zh": "Chinese",
    "zh-cn": "Chinese (Simplified)",
    "zh-tw": "Chinese (Traditional)",
    "pl": "Polish",
    "sk": "Slovak",
    "cs": "Czech",
    "it": "Italian",
    "tr": "Turkish",
    "uk": "Ukrainian",
    "nl": "Dutch",
    "sv": "Swedish",
    "fi": "Finnish",
    "da": "Danish",
    "no": "Norwegian",
    "hu": "Hungarian",
    "asl": "American Sign Language",
    "el": "Greek",
}


def title_case(text: Column) -> Column:
    """Capital after every non-letter, so `zh-hk` gives `Zh-Hk` (`initcap` alone would not)."""
    runs = F.regexp_extract_all(text, F.lit("([A-Za-z]+|[^A-Za-z]+)"), F.lit(1))
    return F.array_join(F.transform(runs, F.initcap), "")


def language_label(code: Column) -> Column:
    """`code - Name`; an unlisted code is title-cased, null stays null."""
    names = F.create_map(*[F.lit(part) for pair in LANGUAGE_NAMES.items() for part in pair])
    name = F.coalesce(F.try_element_at(names, code), title_case(code))
    return F.concat(code, F.lit(" - "), name)


def display_name(name: Column, login: Column) -> Column:
    """The login where the name is not plain ASCII; a null name counts as ASCII."""
    return F.when(name.rlike(r"[^\x00-\x7F]"), login).otherwise(name)


def audience_label(mature: Column) -> Column:
    return F.when(mature, "Mature").when(~mature, "Not Mature")


def clean_language(code: Column) -> Column:
    return F.upper(F.coalesce(F.nullif(code, F.lit("")), F.lit("unknown")))
