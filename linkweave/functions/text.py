"""Text expressions, all built from Spark's own functions.

Each function takes column names and returns a column. The expressions are given
to Spark as SQL text, which it parses in one step.
"""

from __future__ import annotations

import unicodedata
from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from linkweave import schemas as S

# Latin letters that have no decomposition, spelled in ASCII.
LONG_SPELLINGS = {"ß": "ss", "æ": "ae", "œ": "oe", "þ": "th", "ŋ": "ng", "ĳ": "ij"}
SHORT_SPELLINGS = {"ø": "o", "đ": "d", "ð": "d", "ł": "l", "ħ": "h", "ı": "i", "ŧ": "t"}

# The characters Python's str.strip() takes off.
WHITESPACE = (
    r"[\x09-\x0d\x1c-\x20\x85\xa0\x{1680}\x{2000}-\x{200a}"
    r"\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)

SENTINEL = "null"


def _accented_letters() -> tuple[str, str]:
    """Lower-case Latin letters with marks, and the plain letter under each.

    The rule is Unicode decomposition: a letter counts when its first
    decomposed character is a-z.
    """
    letters, plain = list(SHORT_SPELLINGS), list(SHORT_SPELLINGS.values())
    for code in chain(range(0x00C0, 0x0250), range(0x1E00, 0x1F00)):
        letter = chr(code)
        base = unicodedata.normalize("NFD", letter)[0]
        if letter == letter.lower() and "a" <= base <= "z":
            letters.append(letter)
            plain.append(base)
    return "".join(letters), "".join(plain)


ACCENTED, PLAIN = _accented_letters()

#: Blocks of lower-case or caseless letters whose Unicode names spell their sounds.
NAMED_SCRIPTS = {
    "GREEK SMALL LETTER ": range(0x0370, 0x0400),
    "CYRILLIC SMALL LETTER ": range(0x0400, 0x0530),
    "HEBREW LETTER ": range(0x05D0, 0x05F3),
    "ARABIC LETTER ": range(0x0620, 0x06D4),
    "HIRAGANA LETTER ": range(0x3041, 0x3097),
    "KATAKANA LETTER ": range(0x30A1, 0x30FB),
}
#: First words of such names that say how a letter is written, not how it sounds.
_FORMS = ("FINAL ", "SMALL ", "BYELORUSSIAN-UKRAINIAN ", "UKRAINIAN ", "SHORT ", "DOTLESS ")


def _sounding(name: str) -> str:
    """The letter that a letter's name begins to spell; of names such as EN and ES the consonant."""
    for form in _FORMS:
        name = name.removeprefix(form)
    word = name.split()[0].lower() if name.split() else ""
    if word == "ie":
        return "e"
    if len(word) == 2 and word[0] == "e" and word[1] not in "aeiou":
        return word[1]
    return word[:1]


def _named_letters() -> tuple[str, str]:
    """Letters of other alphabets, and the Latin letter that stands for each."""
    letters, plain = [], []
    for start, codes in NAMED_SCRIPTS.items():
        for code in codes:
            # A letter with marks sounds as the letter under them.
            base = unicodedata.normalize("NFD", chr(code))[0]
            name = unicodedata.name(base, "")
            sound = _sounding(name[len(start):]) if name.startswith(start) else ""
            # Signs without a sound of their own begin no name.
            if "a" <= sound <= "z" and "SIGN" not in name:
                letters.append(chr(code))
                plain.append(sound)
    return "".join(letters), "".join(plain)


OTHER_LETTERS, OTHER_PLAIN = _named_letters()


def _hangul_initials() -> str:
    """The Latin letter of each first consonant of a syllable; the silent one is a blank."""
    names = [unicodedata.name(chr(0x1100 + i)).split()[-1] for i in range(19)]
    return "".join(" " if n == "IEUNG" else n.removeprefix("SSANG")[0].lower() for n in names)


def _hangul_vowels() -> str:
    return "".join(unicodedata.name(chr(0x1161 + i)).split()[-1][0].lower() for i in range(21))


HANGUL_INITIALS, HANGUL_VOWELS = _hangul_initials(), _hangul_vowels()
#: Syllables are numbered by first consonant, vowel and last consonant.
HANGUL_FIRST, HANGUL_LAST, PER_INITIAL, PER_VOWEL = 0xAC00, 0xD7A3, 588, 28
INITIALS = "".join(spelling[0] for spelling in LONG_SPELLINGS.values())


def _lower_name(column: str) -> str:
    """Lower case, with the letters 'null' taken out wherever they stand."""
    return f"lower(replace({column}, '{SENTINEL}', ''))"


def ascii_name_sql(column: str) -> str:
    name = _lower_name(column)
    for letter, spelling in LONG_SPELLINGS.items():
        name = f"replace({name}, '{letter}', '{spelling}')"
    return f"regexp_replace(translate({name}, '{ACCENTED}', '{PLAIN}'), '[^a-z -]', '')"


def block_key_sql(column: str) -> str:
    letters = ACCENTED + "".join(LONG_SPELLINGS) + OTHER_LETTERS
    name = f"translate({_lower_name(column)}, '{letters}', '{PLAIN + INITIALS + OTHER_PLAIN}')"
    first = f"regexp_extract({name}, '[a-z -]|[{chr(HANGUL_FIRST)}-{chr(HANGUL_LAST)}]', 0)"
    at = f"(ascii({first}) - {HANGUL_FIRST})"
    initial = f"substr('{HANGUL_INITIALS}', {at} DIV {PER_INITIAL} + 1, 1)"
    vowel = f"substr('{HANGUL_VOWELS}', {at} % {PER_INITIAL} DIV {PER_VOWEL} + 1, 1)"
    syllable = f"if({initial} = ' ', {vowel}, {initial})"
    return f"nullif(if({first} >= '{chr(HANGUL_FIRST)}', {syllable}, {first}), '')"


def ascii_name(column: str) -> Column:
    """Lower-case ASCII form of a name: a-z, blank and hyphen only.

    Scripts other than Latin leave nothing.
    """
    return F.expr(ascii_name_sql(column))


def block_key(column: str) -> Column:
    """First character of the name in ASCII; NULL when nothing is left of it.

    Only the first letter of a long spelling can matter, so one translation does. Greek, Cyrillic,
    Hebrew, Arabic, kana and Hangul have the letter that the Unicode name of theirs spells, so
    keys stay a to z; scripts whose signs have no such names, as Han, give none.
    """
    return F.expr(block_key_sql(column))


def block_keys() -> Column:
    """Distinct block keys of a record, sorted; the name columns depend on its type."""
    keys = []
    for column in S.NAME_PARTS:
        types = [f"'{kind}'" for kind, columns in S.BLOCK_COLUMNS.items() if column in columns]
        keys.append(
            f"CASE WHEN record_type IN ({', '.join(types)}) THEN {block_key_sql(column)} END"
        )
    return F.expr(f"array_sort(array_distinct(array_compact(array({', '.join(keys)}))))")


def name_terms(columns: list[str] = S.NAME_PARTS) -> Column:
    """Distinct ASCII name parts of a record, sorted."""
    parts = [f"nullif(trim({ascii_name_sql(c)}), '')" for c in columns]
    return F.expr(f"array_sort(array_distinct(array_compact(array({', '.join(parts)}))))")


def ascii_full_name(columns: list[str] = S.NAME_PARTS) -> Column:
    parts = [f"nullif({ascii_name_sql(c)}, '')" for c in columns]
    return F.expr(f"concat_ws(' ', {', '.join(parts)})")


def drop_sentinel(column: str) -> Column:
    """The whole value 'null' as a real NULL."""
    return F.expr(f"nullif({column}, '{SENTINEL}')")


def fill_sentinel(column: str) -> Column:
    """A real NULL as the text 'null', the form older tables hold."""
    return F.expr(f"coalesce(CAST({column} AS STRING), '{SENTINEL}')")


def prep_text(column: str) -> Column:
    """Lower case, whitespace taken off both ends."""
    return F.lower(F.regexp_replace(column, f"^{WHITESPACE}+|{WHITESPACE}+$", ""))


def full_name(*parts: str) -> Column:
    """Name parts joined by blanks; missing parts are skipped."""
    return F.concat_ws(" ", *parts)


def field_text(column: str, length: int = 1000) -> Column:
    """Any value as text of at most ``length`` characters (the review field's size)."""
    return F.expr(f"substring(CAST({column} AS STRING), 1, {length})")


def join_list(column: str) -> Column:
    return F.array_join(column, "|")


def split_list(column: str) -> Column:
    return F.split(column, "[|]")


def composite_key(kind: str, number: str) -> Column:
    """``type_id``, the text key of a record."""
    return F.expr(f"concat_ws('_', {kind}, CAST({number} AS STRING))")


_COMPOSITE = "^(.*)_([^_]*)$"


def key_type(key: str) -> Column:
    """Record type of a text key, split at the last underscore."""
    return F.regexp_extract(key, _COMPOSITE, 1)


def key_id(key: str) -> Column:
    return F.regexp_extract(key, _COMPOSITE, 2).try_cast("bigint")


def canonical_json(value: Column | str) -> Column:
    """JSON text with sorted keys and no blanks, so equal documents are equal text."""
    return F.to_json(F.try_parse_json(value))


def range_text(value: Column | str) -> Column:
    """Bound of an import range as text; a colon stands before the milliseconds."""
    return F.date_format(value, "yyyy-MM-dd HH:mm:ss:SSS")
