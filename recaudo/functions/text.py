"""Text cleaning: person names and column headers."""

from __future__ import annotations

import re
import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from . import fixed

# FIXED VALUES: wrong spellings of the letter N-tilde and two other letters
# that appear when Latin-1 files are read as UTF-8 (and read twice).
MISENCODED_N = ["ÃƒÂ‘", "Ã‚Â¦", "Ã‘", "Ñ"]
MISENCODED_OTHER = [("Ã‡", "A"), ("ÃƒÂ", "I")]
# Accented capitals and their plain letters (translate tables, same length).
ACCENTED = "ÁÀÂÄÃÅÉÈÊËÍÌÎÏÓÒÔÖÕØÚÙÛÜÝÇÑ"
PLAIN = "AAAAAAEEEEIIIIOOOOOOUUUUYCN"
# Honorifics removed as whole words (after accents are folded).
HONORIFICS = ["SENORES", "SENORAS", "SENORA", "SENOR", "SRES", "SRTA", "SRA", "SR"]


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _without(x: Column, text: str, to: str) -> Column:
    """Every match of ``text`` becomes ``to``; a text without pattern signs is searched as it is."""
    if re.search(r"[.^$*+?{}\[\]\\|()]", text):
        return F.regexp_replace(x, text, to)
    return F.replace(x, F.lit(text), F.lit(to))


def strict_person_name(c: Column | str) -> Column:
    """The reports' own pass order, letter for letter: each fixed text is
    deleted where it stands, so words may glue together and accented vowels
    vanish. For comparing with old reports; :func:`clean_person_name` is the
    cleaned rule."""
    x = F.upper(_c(c))
    for wrong in fixed.STRICT_N:
        x = _without(x, wrong, "N")
    for wrong, right in fixed.STRICT_LETTERS:
        x = _without(x, wrong, right)
    for text in fixed.STRICT_DELETED:
        x = _without(x, text, "")
    x = F.regexp_replace(x, "[^A-Z& ]", "")
    for text in fixed.STRICT_DELETED_LAST:
        x = _without(x, text, "")
    return F.regexp_replace(x, r"^(A\s+| )+", "")


def clean_person_name(c: Column | str, strict: bool = False) -> Column:
    """Upper-case person name with only ``A-Z``, ``&`` and single blanks.

    Steps: ``ß`` -> ``SS`` (so that every engine agrees on upper case),
    repair mis-encoded letters, upper case, fold accents, drop honorifics on word
    boundaries (``SR.``, ``SRA``, ``SR(A)``, ``SEÑOR(A)`` ...), turn every
    other character into a blank (so words never glue together), collapse
    blanks, drop leading ``A `` words.

    Intended semantics of the reference's ~75 regex passes, without their
    side effects (words glued at double blanks, letters eaten by unescaped
    dots, accented vowels deleted instead of folded).
    """
    if strict:
        return strict_person_name(c)
    x = F.replace(_c(c), F.lit("ß"), F.lit("SS"))
    # repair before upper(): the mis-encodings contain lower-case letters
    fixed_enc = x
    for bad in MISENCODED_N:
        fixed_enc = F.replace(fixed_enc, F.lit(bad), F.lit("N"))
    for bad, good in MISENCODED_OTHER:
        fixed_enc = F.replace(fixed_enc, F.lit(bad), F.lit(good))
    # every mis-encoding starts with 'Ã' or is 'Ñ': skip the passes otherwise
    x = F.when(x.contains("Ã") | x.contains("Ñ"), fixed_enc).otherwise(x)
    x = F.upper(x)
    x = F.translate(x, ACCENTED, PLAIN)
    # keep only what the honorific rule needs; the rest becomes a blank
    x = F.regexp_replace(x, r"[^A-Z&()/. ]+", " ")
    x = F.when(x.contains("("), F.regexp_replace(x, r"\((A|AS|ES)\)", "$1")).otherwise(x)
    honor = "|".join(HONORIFICS)
    # every honorific contains "SR" or "SENOR": the regex runs only then
    x = F.when(x.contains("SR") | x.contains("SENOR"),
               F.regexp_replace(x, rf"\b({honor})\b\.?", " ")).otherwise(x)
    # every run of characters other than A-Z and & becomes one blank
    x = F.regexp_replace(x, r"[^A-Z&]+", " ")
    x = F.trim(x)
    x = F.regexp_replace(x, r"^(A )+", "")
    return x


def clean_header(name: str) -> str:
    """Column header without accents and without ``{ } . ,`` (schema-level,
    runs on the driver over column names only)."""
    folded = unicodedata.normalize("NFKD", name)
    folded = "".join(ch for ch in folded if not unicodedata.combining(ch))
    return re.sub(r"[{}.,]", "", folded)


def snake(name: str) -> str:
    """Lower case, blanks to underscores (prefix families of the consolidated
    table)."""
    return name.lower().replace(" ", "_")
