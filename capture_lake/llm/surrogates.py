"""Keyed, type-consistent surrogates for personal data, by DataFrame functions only.

Found are e-mail addresses, IPv4 and IPv6 addresses, telephone numbers, card numbers and IBANs
(with right check digits), passport numbers after that word, social-security numbers, access keys, hexadecimal secrets, what a password, token or key is set to, and
names that follow a title, with all their words and particles.  An entity is
its type and its canonical form (digits alone, a telephone number's without country code
and trunk digit, an IPv6 address with all its zeros, or lower case), so all spellings
of one entity get one surrogate, written in the format of each mention: digits
stay digits between the same separators, card numbers keep their length and
whether their check digit holds, IBANs keep country and layout and get right check digits, upper case stays upper case, given names keep
gender and script, private and link-local addresses stay that (global IPv6 ones move to the
range for documentation), shortened ones stay short.

A surrogate is a function of the key, the entity and an attempt number.  Attempt
0 is computed next to the text.  Collisions are looked for over all distinct
entities of the corpus: no two entities share a surrogate, and none is the
canonical form of an entity that occurs.  A further attempt widens formats that have
few places: initials become two, then three, a surname gets one more syllable, a private
address moves to a larger private range.  An entity that is still without a place after
the last attempt gets a placeholder, `[KIND-<128 bits of its keyed hash>]`; nothing fails.
The entities that have to try again (and names whose mentions disagree in gender) form a
table of exceptions, which is joined to the texts that mention them.

Edge cases: a null text stays null, an empty one empty, a very long one is rewritten whole; repeated rows are
rewritten alike; other columns are kept whatever they are called; an empty table
gives an empty result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from capture_lake.llm.common import fresh_names, stored, stored_table, table

DEFAULT_KEY = "surrogate-key"
MAX_ATTEMPTS = 6

# Titles by gender, given names by gender and script, surname syllables by script.
TITLES = {
    "m": ["Mr", "MR", "Herr", "HERR", "Monsieur", "Señor", "Sr", "Don", "Господин", "г-н"],
    "f": ["Mrs", "MRS", "Ms", "Miss", "MISS", "Frau", "FRAU", "Madame", "Mme", "Mlle", "Señora", "Señorita", "Sra", "Srta", "Doña", "Госпожа", "г-жа"],
    "n": ["Dr", "DR", "Prof", "PROF", "Доктор"],
}
GIVEN = {
    ("latin", "m"): ["james", "peter", "carlos", "louis", "martin", "henry", "paul", "victor", "oscar", "simon", "felix", "hugo"],
    ("latin", "f"): ["anna", "maria", "claire", "emma", "julia", "laura", "sofia", "helen", "nora", "alice", "clara", "irene"],
    ("latin", "n"): ["alex", "robin", "sascha", "noel", "kim", "dominique", "andrea", "jordan", "casey", "morgan", "charlie", "sam"],
    ("cyrillic", "m"): ["иван", "пётр", "сергей", "николай", "андрей", "виктор", "павел", "олег"],
    ("cyrillic", "f"): ["анна", "мария", "ольга", "елена", "ирина", "вера", "софия", "нина"],
    ("cyrillic", "n"): ["саша", "женя", "валя", "шура", "слава", "паша", "сима", "тоня"],
}
SYLLABLES = {
    "latin": ["bar", "ben", "cal", "den", "dor", "fen", "gar", "hal", "ker", "lan", "mor", "nor", "per", "ros", "tal", "ver"],
    "cyrillic": ["бар", "вен", "гор", "дол", "зор", "кал", "лен", "мор", "нев", "пол", "рос", "сор", "тал", "фед", "чер", "шов"],
}

#: A host has as many labels as a domain name can have.
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9_%+-][A-Za-z0-9._%+-]*+@(?:[A-Za-z0-9-]++\.){1,126}[A-Za-z]{2,63}+(?![A-Za-z0-9])"
IP = r"(?<![0-9.])(?:(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])\.){3}(?:25[0-5]|2[0-4][0-9]|1[0-9][0-9]|[1-9]?[0-9])(?!\.?[0-9])"
_GROUP = "[0-9A-Fa-f]{1,4}"
#: All eight groups, or a shortened address that is global, unique local or link-local.
IPV6 = (
    rf"(?<![0-9A-Za-z:.])(?:(?:{_GROUP}:){{7}}{_GROUP}|(?:[23][0-9A-Fa-f]{{3}}|[Ff][CcDdEe][0-9A-Fa-f]{{2}})"
    rf"(?:(?::{_GROUP}){{1,5}}::(?:{_GROUP}(?::{_GROUP}){{0,4}})?|::{_GROUP}(?::{_GROUP}){{0,5}}))(?![0-9A-Za-z:]|\.[0-9])"
)
HEX = r"(?<![0-9A-Za-z])[0-9A-Fa-f]{32,}+(?![0-9A-Za-z])"
KEY = r"(?<![0-9A-Za-z])A[KS]IA[0-9A-Z]{16}(?![0-9A-Za-z])"
_ASSIGNS = r"""(?i:password|passwd|pwd|secret|token|api[_-]?key|access[_-]?key)["']?\s{0,3}[=:]\s{0,3}["']?"""
SECRET = rf"""(?=[PpSsTtAa])(?<![0-9A-Za-z]){_ASSIGNS}[^\s"',;]{{8,}}+"""
CARD = r"(?<![0-9A-Za-z])[0-9]{4}(?:[ -]?[0-9]{4}){2}[ -]?[0-9]{1,7}(?![0-9A-Za-z])"
# Length of an IBAN by country.
IBAN_LENGTHS = {
    15: "NO", 16: "BE", 18: "DK FI FO GL NL", 19: "MK SI", 20: "AT BA EE KZ LT LU XK", 21: "CH CR HR LI LV", 22: "BG BH DE GB GE IE ME RS",
    23: "AE GI IL", 24: "AD CZ ES MD PK RO SA SE SK TN VG", 25: "PT", 26: "IS TR", 27: "FR GR IT MC SM", 28: "AL AZ BY CY DO GT HU LB PL",
    29: "BR EG PS QA UA", 30: "JO KW MU", 31: "MT SC",
}
IBAN = (
    "(?<![0-9A-Za-z])(?:"
    + "|".join(rf"(?:{countries.replace(' ', '|')})[0-9]{{2}}(?: ?[0-9A-Z]){{{n - 4}}}" for n, countries in IBAN_LENGTHS.items())
    + ")(?![0-9A-Za-z])"
)
SSN = r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9]|-[0-9])"
_SEP = r"[ .\u00a0\u202f-]"
_TRUNK = rf"(?:{_SEP}?\(0\))?"
#: Numbers with a country code by the lengths of NANP, ru/kz, es, fr, then any other by its groups.
_ABROAD = (
    rf"(?:\+|00{_SEP}?)(?:1(?:{_SEP}?\(?[0-9]{{3}}\)?)(?:{_SEP}?[0-9]){{7}}|7(?:{_SEP}?\(?[0-9]{{3}}\)?)(?:{_SEP}?[0-9]){{7}}"
    rf"|34(?:{_SEP}?[0-9]){{9}}|33{_TRUNK}(?:{_SEP}?[0-9]){{9}}|[1-9][0-9]{{0,2}}{_TRUNK}(?:(?:{_SEP}|/)?\(?[0-9]{{1,15}}+\)?){{1,7}}+)(?![0-9])"
)
#: Grouped national numbers: fr, es, ru, and area code before the rest (de, uk).
_HOME = (
    rf"0[1-9](?:{_SEP}[0-9]{{2}}){{4}}"
    rf"|[6-9][0-9]{{2}}(?:{_SEP}[0-9]{{3}}){{2}}|[6-9][0-9]{{2}}(?:{_SEP}[0-9]{{2}}){{3}}|9[0-9]{_SEP}[0-9]{{3}}(?:{_SEP}[0-9]{{2}}){{2}}"
    rf"|8{_SEP}?\(?[0-9]{{3}}\)?{_SEP}?[0-9]{{3}}{_SEP}[0-9]{{2}}{_SEP}[0-9]{{2}}|\([0-9]{{3}}\){_SEP}?[0-9]{{3}}{_SEP}[0-9]{{2}}{_SEP}[0-9]{{2}}"
    rf"|0[1-9][0-9]{{1,4}}(?:{_SEP}|{_SEP}?/{_SEP}?)[0-9]{{2,5}}(?:{_SEP}[0-9]{{2,5}}){{1,3}}|0[1-9][0-9]{{1,4}}(?:{_SEP}|{_SEP}?/{_SEP}?)[0-9]{{5,9}}"
    rf"|\(0[0-9]{{2,5}}\){_SEP}?[0-9]{{2,9}}(?:{_SEP}[0-9]{{2,5}}){{0,3}}"
)
#: Words that tell an ungrouped number to be a telephone's or a passport's.
_CALLED = "(?i:tel|phone|call|fax|mobile|cell|téléphone|teléfono|telefon|móvil|portable|handy|тел|телефон)"
_PASSPORT = "(?i:passport|passeport|pasaporte|reisepass|паспорт)(?: (?i:no|nr|number|numéro|número|nummer))?"
PASSPORT = rf"(?<=(?<![\p{{L}}]){_PASSPORT}[.:]{{0,2}} {{1,2}})[A-Z]{{0,2}}[0-9]{{6,9}}+(?![0-9A-Za-z])"
PHONE = (
    r"(?<![0-9A-Za-z+])(?:\+?[0-9]{1,3}[ .-]?)?\([0-9]{3}\)[ .-]?[0-9]{3}[ .-]?[0-9]{4}(?![0-9])"
    r"|(?<![0-9A-Za-z+.-])(?:\+[0-9]{1,3}[ .-]?)?[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]|[.-][0-9])"
    rf"|(?<![0-9A-Za-z+.-])(?=(?:\+|00)(?:[^0-9A-Za-z]{{0,2}}[0-9]){{7}}){_ABROAD}"
    rf"|(?<![0-9A-Za-z+.-])(?:{_HOME})(?![0-9]|[.-][0-9])"
    rf"|(?<=(?<![\p{{L}}]){_CALLED}[.:]{{0,2}} {{0,2}})[0-9]{{7,12}}+(?![0-9A-Za-z]|[.-][0-9])"
)
#: Country codes of one and two digits; all others have three.
_COUNTRY = "(?:1|7|2[07]|3[0-469]|4[013-9]|5[1-8]|6[0-6]|8[1246]|9[0-58])"
_TITLE = "(?:" + "|".join(sorted((t for ts in TITLES.values() for t in ts), key=len, reverse=True)) + ")"
#: Titles may be followed by academic ones, the name by lower-case particles; they are kept.
_TITLES = rf"{_TITLE}\.? (?:(?:Dr|Prof|Доктор)\.? ){{0,3}}"
PARTICLES = ["von", "vom", "van", "der", "den", "de", "del", "della", "di", "da", "do", "dos", "das", "du", "des", "la", "las", "los", "le", "el", "zu", "zum", "zur", "ter", "ten", "af", "av", "al", "bin", "ibn", "y"]
_PARTICLES = rf"(?:(?:{'|'.join(PARTICLES)}) ){{0,3}}"
_WORD = rf"(?!{_TITLE}\.? )(?:[dl]['’])?\p{{Lu}}(?:[\p{{L}}\p{{M}}'’-]++|\.)"
_INITIAL = "(?=[" + "".join(sorted({t[0] for ts in TITLES.values() for t in ts})) + "])"
NAME = rf"{_INITIAL}(?<![\p{{L}}\p{{N}}_]){_TITLES}{_PARTICLES}{_WORD}(?: {_PARTICLES}{_WORD})*+"
#: The kind of what looks like an entity and is none.
PLAIN = "plain"
#: What any entity has; texts without it are not searched for entities.
HINT = rf"[0-9@]|:[A-Fa-f]{{0,4}}:|A[KS]IA[0-9A-Z]{{16}}|(?=[PpSsTtAa]){_ASSIGNS}|{_INITIAL}{_TITLE}\.? (?=[\p{{Lu}}a-z])"
PATTERN = "|".join((EMAIL, f"(?=[0-9A-Fa-f]{{1,4}}:)(?:{IPV6})", f"(?=[A-Z]{{2}}[0-9])(?:{IBAN})", f"(?=[A-Z]{{0,2}}[0-9]{{6}})(?:{PASSPORT})", f"(?=[0-9+(])(?:{IP}|{CARD}|{SSN}|{PHONE})", f"(?=[0-9A-Fa-f]){HEX}", f"(?=A){KEY}", SECRET, NAME))

# Letters by script, and the marks that may stand in a secret.
LETTERS = "abcdefghijklmnopqrstuvwxyz"
CYRILLIC = "абвгдежзиклмнопрстуфхцчшэюя"
GREEK = "αβγδεζηθικλμνξοπρστυφχψω"
MARKS = "!#$%&()*+-./<>?@^_|~"


def _digits(c: Column) -> Column:
    return F.regexp_replace(c, "[^0-9]", "")


def _lead(m: Column) -> Column:
    """What stands before the entity in its mention: a title, or what a secret is assigned to."""
    return F.regexp_extract(m, rf"^(?:{_TITLES}|{_ASSIGNS}(?!$))", 0)


def _is_card(m: Column) -> Column:
    """Whether a number in the shape of a card's is one: its first digit is that of an issuer, its check digit is right."""
    return m.rlike("^[2-6]") & (_luhn(_digits(m)) % 10 == 0)


def _by_97(code: Column) -> Column:
    """The remainder by 97 of a code whose letters count as 10 to 35."""
    value = lambda c: F.conv(c, 36, 10).cast("int")
    return F.aggregate(F.split(code, ""), F.lit(0), lambda t, c: F.when(c.rlike("[0-9]"), t * 10 + value(c)).otherwise(t * 100 + value(c)) % 97)


def _is_iban(m: Column) -> Column:
    """Whether a code in the shape of an IBAN is one: its check digits are right."""
    code = F.replace(m, F.lit(" "), F.lit(""))
    return _by_97(F.concat(F.substring(code, F.lit(5), F.length(code)), F.substring(code, 1, 4))) == 1


def _kind(m: Column, lead: Column, bare: Column) -> Column:
    """The type of a mention `m` that is `lead` and the entity `bare`; PLAIN is none and stays."""
    return (
        F.when(m.contains("@") & m.rlike(f"^(?:{EMAIL})$"), "email")
        .when(m.rlike(r"^[0-9]{1,3}(?:\.[0-9]{1,3}){3}$"), "ip")
        .when(m.rlike(f"^(?:{IPV6})$"), "ip6")
        .when(bare.rlike("^[0-9A-Fa-f]{32,}$"), "hex")
        .when(m.rlike(f"^(?:{IBAN})$"), F.when(_is_iban(m), "iban").otherwise(PLAIN))
        .when(m.rlike("^A[KS]IA[0-9A-Z]{16}$"), "key")
        .when(m.rlike("^[A-Z]{1,2}[0-9]{6,9}$"), "passport")
        .when(m.rlike("^[0-9]{3}-[0-9]{2}-[0-9]{4}$"), "ssn")
        .when(m.rlike(f"^(?:{CARD})$"), F.when(_is_card(m), "card").otherwise(PLAIN))
        .when(m.rlike("^[+(0-9]"), "phone")
        .when(lead.rlike("[=:]"), "secret")
        .otherwise("name")
    )


def _canon(bare: Column, kind: Column) -> Column:
    return (
        F.when(kind == "phone", _national(bare)).when(kind.isin("ssn", "card"), _digits(bare)).when(kind == "ip6", _groups(bare))
        .when(kind == "iban", F.lower(F.replace(bare, F.lit(" "), F.lit("")))).otherwise(F.lower(bare))
    )


def _groups(bare: Column) -> Column:
    """An IPv6 address as eight groups of four digits, so all its spellings agree."""
    halves = F.split(F.lower(bare), "::", -1)
    side = lambda i: F.filter(F.split(F.coalesce(F.try_element_at(halves, F.lit(i)), F.lit("")), ":"), lambda g: g != "")
    zeros = F.array_repeat(F.lit("0"), F.lit(8) - F.size(side(1)) - F.size(side(2)))
    return F.array_join(F.transform(F.concat(side(1), zeros, side(2)), lambda g: F.lpad(g, 4, "0")), ":")


def _national(bare: Column) -> Column:
    """The digits of a telephone number without country code and trunk digit, so all its spellings agree."""
    abroad = F.regexp_replace(_digits(bare), rf"^(?:00)?(?:{_COUNTRY}|[0-9]{{3}})", "")
    digits = F.when(bare.rlike(r"^(?:\+|00)"), abroad).otherwise(F.regexp_replace(_digits(bare), r"^(?:0|[178](?=[0-9]{10}$))", ""))
    # a country code without a plus stands before ten digits with a bracketed area code
    ten = bare.rlike(r"^[0-9]{1,3}[ .-]?\([1-9]") & (F.length(digits) > 10)
    return F.when(ten, F.substring(digits, F.length(digits) - 9, F.lit(10))).when(F.length(digits) > 7, F.regexp_replace(digits, "^0", "")).otherwise(digits)


def _gender(lead: Column, canon: Column) -> Column:
    """m, f or n (not told) of a name, by its title or else by a known given name."""
    title = F.regexp_extract(lead, rf"^{_TITLE}", 0)
    given = F.substring_index(canon, " ", 1)
    known = {g: [n for (_, x), names in GIVEN.items() if x == g for n in names] for g in "mf"}
    return (
        F.when(title.isin(TITLES["m"]), "m").when(title.isin(TITLES["f"]), "f")
        .when(canon.contains(" ") & given.isin(known["m"]), "m").when(canon.contains(" ") & given.isin(known["f"]), "f")
        .otherwise("n")
    )


def _number(hashed: Column, at: int, below: int) -> Column:
    """A number under `below` from four hexadecimal digits of a hash."""
    return (F.conv(F.substring(hashed, at, 4), 16, 10).cast("int") % below).cast("int")


def _hash(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("\x1f", F.lit(key), *(p.cast("string") for p in parts)), 256)


def _pick(values: list[str], hashed: Column, at: int) -> Column:
    return F.element_at(F.array(*map(F.lit, values)), _number(hashed, at, len(values)) + 1)


def _luhn(digits: Column) -> Column:
    """The check sum of a digit string; 0 by 10 if its last digit is right."""
    n = F.length(digits)

    def add(total, i):
        x = F.substring(digits, i, F.lit(1)).cast("int")
        twice = x * 2
        return total + F.when((n - i) % 2 == 1, F.when(twice > 9, twice - 9).otherwise(twice)).otherwise(x)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(canon: Column, digits: Column) -> Column:
    n = F.length(canon)
    body = F.concat(F.substring(canon, 1, 1), F.substring(digits, F.lit(2), n - 2))
    check = ((10 - _luhn(F.concat(body, F.lit("0"))) % 10) % 10).cast("string")
    return F.concat(body, F.when(_luhn(canon) % 10 == 0, check).otherwise(F.substring(digits, F.lit(60), F.lit(1))))


def _phone(canon: Column, digits: Column) -> Column:
    from_two = lambda at: ((F.substring(digits, at, 1).cast("int") % 8) + 2).cast("string")
    rest = F.concat(from_two(1), F.substring(digits, 2, 2), from_two(4), F.substring(digits, 5, 60))
    return F.substring(rest, F.lit(1), F.length(canon))


def _secret(canon: Column, hashed: Column, attempt: Column) -> Column:
    """Hexadecimal for hexadecimal, else a letter of the same script for a letter and a digit for a digit;
    marks stay, but in a value of marks alone and in further attempts a mark stands for a mark.  As many
    hash blocks are drawn as the value is long, and each is used once."""
    n = F.length(canon)
    drawn = lambda digits: F.array_join(F.transform(F.sequence(F.lit(0), F.floor((digits - 1) / 64).cast("int")), lambda i: F.sha2(F.concat(hashed, i.cast("string")), 256)), "")

    marks = (attempt > 0) | ~canon.rlike("[\\p{L}\\p{M}\\p{N}]")

    def swap(c, pair):
        h = F.conv(pair, 16, 10).cast("int")
        one_of = lambda chars: F.substring(F.lit(chars), h % len(chars) + 1, F.lit(1))
        return (F.when(c.rlike("[0-9]|\\p{N}"), (h % 10).cast("string")).when(c.rlike("[a-z]"), one_of(LETTERS))
                .when(c.rlike("\\p{IsCyrillic}"), one_of(CYRILLIC)).when(c.rlike("\\p{IsGreek}"), one_of(GREEK))
                .when(c.rlike("\\p{L}|\\p{M}"), one_of(LETTERS)).when(marks, one_of(MARKS)).otherwise(c))

    pairs = F.regexp_extract_all(F.substring(drawn(n * 2), F.lit(1), n * 2), F.lit(".."), F.lit(0))
    other = F.array_join(F.zip_with(F.split(canon, ""), pairs, swap), "")
    return F.when(canon.rlike("^[0-9a-f]+$"), F.substring(drawn(n), F.lit(1), n)).otherwise(other)


def _key(canon: Column, hashed: Column) -> Column:
    def swap(i):
        h = F.conv(F.substring(hashed, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.substring(F.lit(LETTERS + "234567"), h % 32 + 1, F.lit(1))

    return F.concat(F.substring(canon, 1, 4), F.array_join(F.transform(F.sequence(F.lit(0), F.lit(15)), swap), ""))


def _ip(canon: Column, hashed: Column, attempt: Column) -> Column:
    """Private addresses stay private; a range that is too full gives way to a larger one."""
    part = [_number(hashed, at, 256).cast("string") for at in (1, 5, 9)]
    public = F.concat_ws(".", (F.lit(20) + _number(hashed, 13, 100)).cast("string"), *part)
    small, middle = F.concat_ws(".", F.lit("192.168"), *part[1:]), F.concat_ws(".", F.lit("172"), (F.lit(16) + _number(hashed, 13, 16)).cast("string"), *part[1:])
    large = F.concat_ws(".", F.lit("10"), *part)
    is_small, is_middle = canon.startswith("192.168."), canon.rlike(r"^172\.(?:1[6-9]|2[0-9]|3[01])\.")
    return (F.when(is_small & (attempt == 0), small).when((is_small & (attempt == 1)) | (is_middle & (attempt == 0)), middle)
            .when(is_small | is_middle | canon.startswith("10."), large).otherwise(public))


def _ip6(canon: Column, hashed: Column) -> Column:
    """Link-local and unique local addresses stay that, others move to the range for documentation."""
    part = lambda at: F.substring(hashed, at, 4)
    local = F.concat(F.lit("fd"), F.substring(hashed, 17, 2), F.lit(":"), part(21))
    site = F.when(canon.startswith("fe8"), F.lit("fe80:0000")).when(canon.rlike("^f[cd]"), local).otherwise(F.lit("2001:0db8"))
    return F.concat_ws(":", site, F.lit("0000:0000"), part(1), part(5), part(9), part(13))


def _like(code: Column, hashed: Column) -> Column:
    """A letter for a letter and a digit for a digit of a code of at most 32 characters."""

    def swap(c, i):
        h = F.conv(F.substring(hashed, i * 2 + 1, F.lit(2)), 16, 10).cast("int")
        return F.when(c.rlike("[0-9]"), (h % 10).cast("string")).otherwise(F.substring(F.lit(LETTERS), h % 26 + 1, F.lit(1)))

    return F.array_join(F.transform(F.split(code, ""), swap), "")


def _iban(canon: Column, hashed: Column) -> Column:
    """The same country, a letter for a letter and a digit for a digit, right check digits."""
    country, body = F.substring(canon, 1, 2), F.substring(canon, F.lit(5), F.length(canon))
    # one pass per step: the new body is made once and then used twice
    bodies = F.array(_like(body, hashed))
    check = lambda b: F.lpad((98 - _by_97(F.concat(b, country, F.lit("00")))).cast("string"), 2, "0")
    return F.element_at(F.transform(bodies, lambda b: F.concat(country, check(b), b)), 1)


def _email(canon: Column, hashed: Column, key: str, attempt: Column) -> Column:
    local, domain = F.substring_index(canon, "@", 1), F.substring_index(canon, "@", -1)
    site = _hash(key, F.lit("domain"), domain)

    def swap(c, i):
        h = F.conv(F.substring(hashed, (i * 2) % 62 + 1, F.lit(2)), 16, 10).cast("int")
        letter = F.substring(F.lit(LETTERS), h % 26 + 1, F.lit(1))
        return F.when(c.rlike("[0-9]"), (h % 10).cast("string")).when(c.rlike("[a-z]"), letter).otherwise(c)

    mapped = F.array_join(F.transform(F.split(local, ""), swap), "")
    more = F.when(attempt > 0, F.concat(F.lit("."), F.translate(F.substring(hashed, 50, 5), "abcdef", "012345"))).otherwise("")
    top = F.when(F.substring_index(domain, ".", -1).isin("com", "net", "org"), F.substring_index(domain, ".", -1)).otherwise("com")
    name = F.translate(F.substring(site, 1, 8), "0123456789", "ghijklmnop")
    return F.concat(mapped, more, F.lit("@"), name, F.lit(".example."), top)


def _name(canon: Column, gender: Column, key: str, attempt: Column) -> Column:
    """A given name of the same gender and script for the first of several words, an initial for an
    initial, a surname of the same script for any other; particles stay.  A word has one surrogate
    wherever it stands, until a collision makes the whole name try again."""
    again = attempt.cast("string")

    def of(script: str) -> Column:
        letters = LETTERS if script == "latin" else CYRILLIC

        def swap(word, i):
            family, first = _hash(key, F.lit("family"), word, again), _hash(key, F.lit("given"), word, again)
            given = F.when(gender == "m", _pick(GIVEN[script, "m"], first, 1)).when(gender == "f", _pick(GIVEN[script, "f"], first, 1)).otherwise(_pick(GIVEN[script, "n"], first, 1))
            syllable = lambda i: F.element_at(F.array(*map(F.lit, SYLLABLES[script])), F.conv(F.substring(family, i * 4 + 13, F.lit(4)), 16, 10).cast("int") % 16 + 1)
            more = F.array_join(F.transform(F.sequence(F.lit(0), attempt), syllable), "")
            surname = F.concat(*(_pick(SYLLABLES[script], family, at) for at in (1, 5, 9)), F.when(attempt > 0, more).otherwise(""))
            one = lambda i: F.concat(F.substring(F.lit(letters), F.conv(F.substring(first, i * 4 + 1, F.lit(4)), 16, 10).cast("int") % len(letters) + 1, F.lit(1)), F.lit("."))
            initial = F.array_join(F.transform(F.sequence(F.lit(0), attempt), one), " ")
            return F.when(word.isin(PARTICLES), word).when(word.endswith("."), initial).when((i == 0) & canon.contains(" "), given).otherwise(surname)

        return F.array_join(F.transform(F.split(canon, " "), swap), " ")

    return F.when(canon.rlike(r"\p{IsCyrillic}"), of("cyrillic")).otherwise(of("latin"))


def surrogate(kind: Column, canon: Column, gender: Column, hashed: Column, attempt: Column, key: str) -> Column:
    """The canonical surrogate of an entity; `hashed` is `_hash(key, kind, canon, attempt)`."""
    digits = F.translate(hashed, "abcdef", "012345")
    return (
        F.when(kind == "email", _email(canon, hashed, key, attempt))
        .when(kind == "ip", _ip(canon, hashed, attempt))
        .when(kind == "ip6", _ip6(canon, hashed))
        .when(kind == "iban", _iban(canon, hashed))
        .when(kind == "passport", _like(canon, hashed))
        .when(kind.isin("hex", "secret"), _secret(canon, hashed, attempt))
        .when(kind == "key", _key(canon, hashed))
        .when(kind == "card", _card(canon, digits))
        .when(kind == "phone", _phone(canon, digits))
        .when(kind == "ssn", F.substring(digits, F.lit(1), F.length(canon)))
        .otherwise(_name(canon, gender, key, attempt))
    )


def _as_written(lead: Column, bare: Column, kind: Column, made: Column) -> Column:
    """A canonical surrogate in the format of the mention of `bare` after `lead`."""

    def fill(c, i):
        # the digits before those of the surrogate are a country code or trunk digit and stay
        at = F.length(_digits(F.substring(bare, F.lit(1), i))) - F.length(_digits(bare)) + F.length(made)
        return F.when(c.rlike("[0-9]") & (at >= 0), F.substring(made, at + 1, F.lit(1))).otherwise(c)

    def word(old, new):
        return F.when(F.lower(old) == old, new).otherwise(F.initcap(new))

    def case(c, new):
        return F.when(c.rlike("\\p{Lu}"), F.upper(new)).otherwise(new)

    def spaced(c, i):
        at = i - F.length(F.regexp_replace(F.substring(bare, F.lit(1), i), "[^ ]", ""))
        return F.when(c == " ", c).otherwise(F.substring(made, at + 1, F.lit(1)))

    numbers = F.array_join(F.transform(F.split(bare, ""), fill), "")
    code = F.upper(F.array_join(F.transform(F.split(bare, ""), spaced), ""))
    plain = F.regexp_replace(made, "(^|:)0{1,3}(?=[0-9a-f])", "$1")
    short = F.when(bare.contains("::"), F.regexp_replace(plain, "^([0-9a-f:]*?):0(?::0)+:", "$1::")).when(F.length(bare) < 39, plain).otherwise(made)
    address = F.when(bare.rlike("[A-F]"), F.upper(short)).otherwise(short)
    letters = F.array_join(F.zip_with(F.split(bare, ""), F.split(made, ""), case), "")
    cased = (
        F.when(F.lower(bare) == bare, made).when(F.upper(bare) == bare, F.upper(made))
        .when(kind == "name", F.array_join(F.zip_with(F.split(bare, " "), F.split(made, " "), word), " ")).when(kind.isin("hex", "secret"), letters)
        .otherwise(F.concat(F.upper(F.substring(made, 1, 1)), F.substring(made, F.lit(2), F.length(made))))
    )
    new = F.when(kind == PLAIN, bare).when((kind == "ip") | made.startswith("["), made).when(kind == "ip6", address).when(kind == "iban", code).when(kind.isin("card", "phone", "ssn"), numbers).otherwise(cased)
    return F.concat(lead, new)


def _matches(text: Column) -> Column:
    return F.when(text.rlike(HINT), F.regexp_extract_all(text, F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))


def mentions(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """(th, m): the distinct mentions of every distinct text, th its hash."""
    found = docs.select(F.xxhash64(text_col).alias("th"), F.explode(F.array_distinct(_matches(F.col(text_col)))).alias("m"))
    return found.distinct()


def _described(rows: DataFrame) -> DataFrame:
    m = F.col("m")
    rows = rows.withColumn("lead", _lead(m)).withColumn("bare", F.substring(m, F.length("lead") + 1, F.length(m)))
    rows = rows.withColumn("kind", _kind(m, F.col("lead"), F.col("bare"))).withColumn("canon", _canon(F.col("bare"), F.col("kind")))
    return rows.withColumn("gender", F.when(F.col("kind") == "name", _gender(F.col("lead"), F.col("canon"))).otherwise("n")).drop("lead", "bare")


def _placeholder(kind: Column, canon: Column, key: str) -> Column:
    """What stands for an entity whose format has no place left."""
    return F.concat(F.lit("["), F.upper(kind), F.lit("-"), F.substring(_hash(key, F.lit("placeholder"), kind, canon), 1, 32), F.lit("]"))


def exceptions(found: DataFrame, key: str) -> DataFrame:
    """(kind, canon, made) of the entities whose surrogate isn't that of attempt 0.

    `found` has kind, canon and gender of the mentions; the search runs over distinct entities."""
    told = F.max(F.when(F.col("gender") != "n", F.col("gender")))
    entities = found.groupBy("kind", "canon").agg(F.coalesce(told, F.lit("n")).alias("gender"), (F.min("gender") != F.max("gender")).alias("mixed"))
    entities = stored(entities)
    spark = found.sparkSession
    taken = spark.createDataFrame([], "kind string, made string")
    done: list[DataFrame] = []
    pending = entities
    for attempt in range(MAX_ATTEMPTS):
        kind, canon = F.col("kind"), F.col("canon")
        tried = pending.withColumn("hashed", _hash(key, kind, canon, F.lit(attempt)))
        tried = tried.withColumn("made", surrogate(kind, canon, F.col("gender"), F.col("hashed"), F.lit(attempt), key)).drop("hashed")
        real = entities.select("kind", F.col("canon").alias("made"))
        free = tried.join(real, ["kind", "made"], "left_anti").join(taken, ["kind", "made"], "left_anti")
        winner = free.groupBy("kind", "made").agg(F.min(F.struct("canon", "gender", "mixed")).alias("w"))
        won = stored(winner.select("kind", "w.canon", "w.gender", "w.mixed", "made"))
        done.append(won if attempt else won.where("mixed"))
        pending = stored(pending.join(won.select("kind", "canon"), ["kind", "canon"], "left_anti"))
        if pending.isEmpty():
            break
        taken = taken.unionByName(won.select("kind", "made"))
    else:
        done.append(pending.select("kind", "canon", "gender", "mixed", _placeholder(F.col("kind"), F.col("canon"), key).alias("made")))
    return reduce(DataFrame.unionByName, done).select("kind", "canon", "made")


def _rewritten(text: Column, key: str, special: Column | None) -> Column:
    """`text` with every mention replaced; `special` maps kind:canon to an exception's surrogate.

    A mention goes through one transform per step, so no step repeats the one before."""
    first = F.lit(0)

    def made(x: Column) -> Column:
        new = surrogate(x["kind"], x["canon"], x["gender"], x["hashed"], first, key)
        if special is None:
            return new
        return F.coalesce(F.try_element_at(special, F.concat(x["kind"], F.lit(":"), x["canon"])), new)

    def step(rows: Column, *kept: str, **more) -> Column:
        return F.transform(rows, lambda x: F.struct(*(x[k].alias(k) for k in kept), *(f(x).alias(n) for n, f in more.items())))

    steps = F.transform(_matches(text), lambda m: F.struct(m.alias("m"), _lead(m).alias("lead")))
    steps = step(steps, "m", "lead", bare=lambda x: F.substring(x["m"], F.length(x["lead"]) + 1, F.length(x["m"])))
    steps = step(steps, "lead", "bare", kind=lambda x: _kind(x["m"], x["lead"], x["bare"]))
    steps = step(steps, "lead", "bare", "kind", canon=lambda x: _canon(x["bare"], x["kind"]))
    steps = step(steps, "lead", "bare", "kind", "canon", gender=lambda x: _gender(x["lead"], x["canon"]),
                 hashed=lambda x: _hash(key, x["kind"], x["canon"], first))
    steps = step(steps, "lead", "bare", "kind", made=made)
    new = F.transform(steps, lambda x: _as_written(x["lead"], x["bare"], x["kind"], x["made"]))
    # as many pieces between the mentions as there are mentions, and one more
    pieces = F.split(text, PATTERN, -1)
    joined = F.array_join(F.zip_with(pieces, F.concat(new, F.array(F.lit(""))), lambda p, n: F.concat(p, n)), "")
    return F.when(text.rlike(HINT) & text.rlike(PATTERN), joined).otherwise(text)


def pseudonymize(docs: DataFrame, key: str = DEFAULT_KEY, text_col: str = "text") -> DataFrame:
    """`docs` with every detected entity in `text_col` replaced by its surrogate."""
    found = stored(_described(mentions(docs, text_col)).where(F.col("kind") != PLAIN))
    special = stored_table(exceptions(found, key), "surrogates")
    if special.isEmpty():
        return docs.withColumn(text_col, _rewritten(F.col(text_col), key, None))
    th, made = fresh_names(docs, "th", "made")
    entry = F.struct(F.concat("kind", F.lit(":"), "canon").alias("entity"), "made")
    by_text = found.select("th", "kind", "canon").distinct().join(special, ["kind", "canon"]).groupBy("th").agg(F.map_from_entries(F.collect_list(entry)).alias("made"))
    by_text = stored_table(by_text, "surrogates_by_text").select(F.col("th").alias(th), F.col("made").alias(made))
    joined = docs.withColumn(th, F.xxhash64(text_col)).join(by_text, th, "left")
    return joined.withColumn(text_col, _rewritten(F.col(text_col), key, F.col(made))).select(*docs.columns)


def _counts(m: Column) -> Column:
    """Whether a match is an entity: what only looks like a card or an IBAN is none."""
    return F.when(m.rlike(f"^(?:{CARD})$"), _is_card(m)).when(m.rlike(f"^(?:{IBAN})$"), _is_iban(m)).otherwise(True)


def op2_pii_surrogates(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", F.size(F.filter(_matches(F.coalesce("text", F.lit(""))), _counts)).alias("n_entities"))
    return pseudonymize(docs)
