"""ISO language and country codes, taken from the Java runtime's own tables; what differs from ISO's names stands here."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

# Bibliographic and common three-letter codes.
THREE_LETTER = {"eng": "en", "fra": "fr", "fre": "fr", "spa": "es", "deu": "de", "ger": "de", "ita": "it", "por": "pt"}
# ISO 3166 short names where the runtime's English names differ.
ISO_NAMES = {
    "BN": "Brunei Darussalam", "BO": "Bolivia, Plurinational State of", "CD": "Congo, The Democratic Republic of the", "CG": "Congo", "CI": "Côte d'Ivoire",
    "CV": "Cabo Verde", "FK": "Falkland Islands (Malvinas)", "FM": "Micronesia, Federated States of", "HK": "Hong Kong",
    "IR": "Iran, Islamic Republic of", "KP": "Korea, Democratic People's Republic of", "KR": "Korea, Republic of", "LA": "Lao People's Democratic Republic",
    "MD": "Moldova, Republic of", "MM": "Myanmar", "MO": "Macao", "PS": "Palestine, State of", "RU": "Russian Federation", "SY": "Syrian Arab Republic",
    "TR": "Türkiye", "TW": "Taiwan, Province of China", "TZ": "Tanzania, United Republic of", "VA": "Holy See (Vatican City State)",
    "VE": "Venezuela, Bolivarian Republic of", "VG": "Virgin Islands, British", "VI": "Virgin Islands, U.S.", "VN": "Viet Nam",
    "SH": "Saint Helena, Ascension and Tristan da Cunha", "AG": "Antigua and Barbuda", "BA": "Bosnia and Herzegovina", "TT": "Trinidad and Tobago",
    "KN": "Saint Kitts and Nevis", "LC": "Saint Lucia", "VC": "Saint Vincent and the Grenadines", "ST": "Sao Tome and Principe",
}
#: Codes that the runtime keeps beside the ones that replaced them.
RETIRED = {"iw", "in", "ji"}


def _jvm():
    return SparkSession.active().sparkContext._jvm


@lru_cache(maxsize=1)
def languages() -> dict[str, str]:
    """Two- and three-letter code to two-letter code."""
    locale = _jvm().java.util.Locale
    found: dict[str, str] = {}
    for code in locale.getISOLanguages():
        if len(code) == 2 and code not in RETIRED:
            found[code] = found[locale.forLanguageTag(code).getISO3Language()] = code
    return found


@lru_cache(maxsize=1)
def countries() -> dict[str, str]:
    locale = _jvm().java.util.Locale
    return {c: locale("", c).getDisplayCountry(locale.ENGLISH) for c in locale.getISOCountries()} | ISO_NAMES


def _lookup(table: dict[str, str], c: Column) -> Column:
    return F.try_element_at(F.create_map(*(F.lit(x) for kv in table.items() for x in kv)), c)


def language_alpha2(c: Column) -> Column:
    """Lower case with hyphens; by the ISO table, else two letters as they are, else the common three-letter codes, else null."""
    code = F.replace(F.lower(F.trim(c)), F.lit("_"), F.lit("-"))
    return F.coalesce(_lookup(languages(), code), F.when(code.rlike(r"^[a-z]{2}\z"), code), _lookup(THREE_LETTER, code))


def country_name(c: Column) -> Column:
    return _lookup(countries(), c)
