"""DuckDB (RE2) spelling of the tokeniser, for the oracle queries.

RE2 has no class intersection and its ``\\s`` lacks U+000B, so the Java
patterns are rewritten with explicit classes that match the same
characters (checked character by character over the whole BMP).
"""

from __future__ import annotations

from wardline.functions.text import MIN_TOKEN_LENGTH, usable_stopwords

JAVA_SPACE = r"[\t\n\x0B\f\r ]"
PUNCT_RE2 = r"[ -\-./:;<=>?@\[\\\]^_`{}~−]"


def cleaned_sql(text: str) -> str:
    e = f"regexp_replace(COALESCE({text}, ''), '{PUNCT_RE2}', ' ', 'g')"
    e = f"regexp_replace({e}, '\\w*\\d\\w*', ' ', 'g')"
    single = f"{JAVA_SPACE}[A-Z,a-z]{JAVA_SPACE}"
    e = f"regexp_replace({e}, '{single}', ' ', 'g')"
    return f"regexp_replace({e}, '{single}', ' ', 'g')"


def tokens_sql(text: str, stopwords=None) -> str:
    words = usable_stopwords(stopwords or [])
    cond = (f"length(t) >= {MIN_TOKEN_LENGTH} AND regexp_full_match(t, '\\p{{L}}+') "
            f"AND NOT regexp_matches(t, '[\\x{{10000}}-\\x{{10FFFF}}]')")
    if words:
        lst = ", ".join("'" + w.replace("'", "''") + "'" for w in words)
        cond += f" AND NOT list_contains([{lst}], t)"
    split = f"regexp_split_to_array(lower({cleaned_sql(text)}), '{JAVA_SPACE}')"
    return f"list_filter({split}, lambda t: {cond})"
