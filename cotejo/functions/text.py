"""Text normalisation as native column expressions (no Python per row).

Python's Unicode folds are reproduced with ``translate`` tables generated from ``unicodedata``. The tables cover
every assigned character; private use passes through unchanged.
"""

import unicodedata
from functools import lru_cache
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

# What Python's str.strip/str.split and the regex \s treat as white space (fixed values).
SPACE = r"\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"

_SPACE_CHARACTERS = "".join(chr(cp) for cp in range(0x3001) if chr(cp).isspace())
_NON_ASCII = r"[^\x00-\x7F]"
_BEYOND_LATIN1 = r"[^\x00-\x7F\xC0-\xFF]"

_PAGE_BITS = 8
_ENTRY_END = "\x01"
# Hangul syllables and the jamo they are made of: leads, vowels, tails (fixed ranges of Unicode).
_FIRST_SYLLABLE, _LAST_SYLLABLE = 0xAC00, 0xD7A3
_JAMO = tuple("".join(map(chr, span)) for span in (range(0x1100, 0x1113), range(0x1161, 0x1176), range(0x11A8, 0x11C3)))

# A case id inside running text: year, two letter groups, number (fixed value).
CASE_ID_PATTERN = r"[0-9]{4}-[A-Z]+-[A-Z]+-[0-9]+"

NO_STATUS = "SIN_ESTADO"

# Month names as printed in report titles (fixed values).
MONTH_NAMES = (
    "ENERO", "FEBRERO", "MARZO", "ABRIL", "MAYO", "JUNIO",
    "JULIO", "AGOSTO", "SETIEMBRE", "OCTUBRE", "NOVIEMBRE", "DICIEMBRE",
)


def _col(c):
    return F.col(c) if isinstance(c, str) else c


@lru_cache(maxsize=None)
def _fold_table(form, dropped):
    """(from, to, expansions) for one normal form; characters past the end of ``to`` are deleted."""
    drop = {
        "marks": lambda ch: unicodedata.combining(ch) != 0,
        "nonspacing": lambda ch: unicodedata.category(ch) == "Mn",
        "non_ascii": lambda ch: ord(ch) > 0x7F,
    }[dropped]
    single, removed, expansions = {}, [], {}
    for cp in chain(range(0x80, 0xD800), range(0xF900, 0x32000), range(0xE0000, 0xE1000)):
        ch = chr(cp)
        kept = "".join(x for x in unicodedata.normalize(form, ch) if not drop(x))
        if kept == ch:
            continue
        if len(kept) == 1:
            single[ch] = kept
        elif kept:
            expansions[ch] = kept
        elif dropped != "non_ascii":
            removed.append(ch)
    return "".join(single) + "".join(removed), "".join(single.values()), expansions


@lru_cache(maxsize=None)
def _expansion_pages(form, dropped):
    """(page numbers, entries): the expansions as pages of 256 code points, for ``_expanded``.

    The page of a code point is looked up by its high bits (-1: no page), the entry by page and low bits; a character
    without expansion is its own entry. ASCII is not looked up, and Hangul syllables are left to arithmetic.
    """
    _, _, expansions = _fold_table(form, dropped)
    points = {ord(k): v for k, v in expansions.items() if not _FIRST_SYLLABLE <= ord(k) <= _LAST_SYLLABLE}
    pages = sorted({cp >> _PAGE_BITS for cp in points})
    numbers = [-1] * (max(pages, default=-1) + 1)
    entries = []
    for n, page in enumerate(pages):
        numbers[page] = n
        low = page << _PAGE_BITS
        entries += [points.get(cp, chr(cp) if cp > 0x7F else "") for cp in range(low, low + (1 << _PAGE_BITS))]
    return ",".join(map(str, numbers)), _ENTRY_END.join(entries)


def _expanded(letter: Column, form: str, dropped: str) -> Column:
    """One character as its expansion, in constant time whatever the script."""
    numbers, entries = _expansion_pages(form, dropped)
    # Both lists are split while the plan is made and are literals from then on.
    pages = F.split(F.lit(numbers), ",").cast("array<int>")
    table = F.split(F.lit(entries), _ENTRY_END)
    cp = F.ascii(letter)
    at = F.get(pages, F.shiftright(cp, _PAGE_BITS)) * (1 << _PAGE_BITS) + cp.bitwiseAND((1 << _PAGE_BITS) - 1)
    mapped = F.coalesce(F.get(table, at), letter)
    if dropped == "non_ascii":
        return mapped
    s = cp - _FIRST_SYLLABLE
    jamo = F.concat(*[F.substring(F.lit(row), (n + 1).cast("int"), F.lit(1)) for row, n in zip(_JAMO, (s / 588, s % 588 / 28))])
    tail = F.when(s % 28 > 0, F.substring(F.lit(_JAMO[2]), s % 28, F.lit(1))).otherwise("")
    return F.when((s >= 0) & (cp <= _LAST_SYLLABLE), F.concat(jamo, tail)).otherwise(mapped)


def _fold(c: Column, form: str, dropped: str) -> Column:
    """Decompose and drop characters; meant for values that are not plain ASCII."""
    source, target, expansions = _fold_table(form, dropped)

    def rule(text):
        if expansions:
            # Ligatures, fractions, syllables and the like turn into several characters; no Latin-1 letter does. Only
            # values beyond that take this branch, and only their non-ASCII characters are looked up.
            letters = F.transform(F.split(text, ""), lambda x: F.when(x < F.lit("\x80"), x).otherwise(_expanded(x, form, dropped)))
            text = F.when(text.rlike(_BEYOND_LATIN1), F.array_join(letters, "")).otherwise(text)
        text = F.translate(text, source, target)
        return F.regexp_replace(text, _NON_ASCII, "") if dropped == "non_ascii" else text

    # The one-element array names the value once. Filters on a key are pushed down with the whole expression, and
    # every further mention of an input that is itself computed would multiply the plan.
    return F.get(F.transform(F.array(c), rule), F.lit(0))


def _is_ascii(c: Column) -> Column:
    """As many bytes as characters."""
    return F.octet_length(c) == F.length(c)


def strip(c) -> Column:
    """Trim every kind of white space, not only blanks."""
    return F.btrim(_col(c).cast("string"), F.lit(_SPACE_CHARACTERS))


def squeeze(c: Column) -> Column:
    """Trim and collapse every run of white space to one blank."""
    return F.btrim(F.regexp_replace(c, f"[{SPACE}]+", " "), F.lit(" "))


def fold_key(c) -> Column:
    """Matching key: null to "", trimmed, inner blanks collapsed, accents removed, upper case."""
    text = F.coalesce(_col(c).cast("string"), F.lit(""))
    # Printable ASCII without doubled blanks only needs trimming.
    special = text.rlike("[^ -~]|  ")
    return F.upper(F.when(special, _fold(squeeze(text), "NFKD", "marks")).otherwise(F.btrim(text)))


def fold_ascii(c) -> Column:
    """Null to "", trimmed, reduced to ASCII, upper case. Inner blanks stay as they are."""
    text = strip(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.upper(F.when(_is_ascii(text), text).otherwise(_fold(text, "NFKD", "non_ascii")))


def drop_accents(c) -> Column:
    """Canonical decomposition without nonspacing marks; the case is kept."""
    text = _col(c)
    return F.when(_is_ascii(text), text).otherwise(_fold(text, "NFD", "nonspacing"))


def trim_upper(c) -> Column:
    """Null to "", trimmed, upper case: the comparison form of a cell."""
    return F.upper(strip(F.coalesce(_col(c).cast("string"), F.lit(""))))


def upper_keep_null(c) -> Column:
    """Trimmed upper case; null stays null instead of turning into the text NAN."""
    return F.upper(strip(c))


def is_blank(c) -> Column:
    return _col(c).isNull() | (strip(c) == "")


def tidy(c) -> Column:
    """Collapse blanks and underscores, then strip blanks, underscores and hyphens at both ends."""
    text = squeeze(F.coalesce(_col(c).cast("string"), F.lit("")))
    return F.btrim(F.regexp_replace(text, "_+", "_"), F.lit(" _-"))


def extract_case_id(c) -> Column:
    """First case id in the upper-cased text, "" if there is none."""
    return F.coalesce(F.regexp_extract(F.upper(_col(c).cast("string")), CASE_ID_PATTERN, 0), F.lit(""))


def status_label(c) -> Column:
    """Blank status gets a visible label; anything else is kept as written."""
    return F.when(is_blank(c), F.lit(NO_STATUS)).otherwise(_col(c))


def file_suffix(name) -> Column:
    """Lower-cased suffix with its dot; a leading dot alone is part of the name."""
    return F.lower(F.regexp_extract(_col(name), r"(?s)^.+(\.[^.]+)$", 1))


def file_stem(name) -> Column:
    return F.regexp_replace(_col(name), r"(?s)^(.+)\.[^.]+$", "$1")


def split_file_name(name):
    """(CONSECUTIVO, ASUNTO, EXPEDIENTE) from a name written as ``number_subject_case.ext``.

    The first part is the number. With three parts or more the last is the case id and everything between is the
    subject; with two the second is the subject.
    """
    parts = F.filter(F.transform(F.split(file_stem(name), "_"), tidy), lambda p: p != "")
    n = F.size(parts)
    number = F.when(n >= 1, F.element_at(parts, 1)).otherwise("")
    subject = (
        F.when(n >= 3, F.array_join(F.slice(parts, F.lit(2), F.greatest(n - 2, F.lit(0))), " - "))
        .when(n == 2, F.element_at(parts, 2))
        .otherwise("")
    )
    case_id = F.when(n >= 3, F.element_at(parts, -1)).otherwise("")
    return number, subject, case_id


def relative_folder(path, base) -> Column:
    """Folder of ``path`` below ``base`` ("." for the base itself), or the whole folder outside it."""
    root = base.rstrip("/")
    folder = F.regexp_replace(_col(path), r"/[^/]*$", "")
    return (
        F.when(folder == root, F.lit("."))
        .when(F.startswith(folder, F.lit(root + "/")), F.substr(folder, F.lit(len(root) + 2)))
        .otherwise(folder)
    )


def month_label(month) -> Column:
    """Month name for titles; a number outside 1-12 gives MES_n."""
    m = _col(month)
    names = F.array(*[F.lit(x) for x in MONTH_NAMES])
    return F.when(m.between(1, 12), F.get(names, m.cast("int") - 1)).otherwise(
        F.format_string("MES_%d", m)
    )


def join_names(c, sep=", ") -> Column:
    return F.array_join(_col(c), sep)


def report_title(subject, month, year) -> Column:
    """Title row of a monthly report; ``subject`` is the caller's text."""
    return F.format_string("%s %s %d", F.lit(subject), month, year)
