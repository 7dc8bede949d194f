"""PII: surrogate generation.

1. Detection, one pass over the whole texts: e-mail addresses, phone numbers,
   payment cards (Luhn), IBANs (mod 97), social security numbers, IP
   addresses, credentials (password / token / key assignments, access key ids)
   and personal names (after a title, or a known given name before a
   capitalised surname).  Names and secrets found are looked up again in the
   whole of their text, so a bare "Doe" goes as well.  Only places and
   canonical values leave the pass.
2. Every distinct (kind, canonical value) of the corpus gets a surrogate from a
   keyed hash (HMAC-SHA256): same kind, same character classes and
   punctuation, valid check digits, names of the same gender and script.  One
   value has one surrogate everywhere, so coreference holds, also between
   "Mrs. Jane Doe" and "Ms. Doe" (given name and surname are values of their
   own).
3. Collision checks: a surrogate may equal neither a real value of its kind in
   the corpus nor another value's surrogate; the rows that do (all but the
   smallest value of a surrogate) are drawn again with the next attempt number
   until none is left.  Each round is a join and a window over the values that
   are still open.
4. The surrogates, written in the form of each mention (separators, letter
   case), are gathered per row and put into the text.

Counts per value never meet in one task: mentions join the value table, a
skewed key there is split by Spark.

Defined results: a null text stays null with no entities; rows without
entities come back unchanged; repeated rows are replaced alike; a null id is
carried as null; an empty table gives an empty result.  Only the named columns
are read.
"""

from __future__ import annotations

import hashlib
import hmac
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retally.llm.shared import materialise

ATTEMPTS = 100
SLICE_ROWS = 256      # texts taken out of an Arrow batch at once


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, SLICE_ROWS):
            yield batch.slice(at, SLICE_ROWS)

# Titles and their gender (f, m, n unknown).
TITLES = {
    "Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Mister": "m", "Sir": "m", "Lady": "f", "Dr": "n", "Prof": "n",
    "Herr": "m", "Herrn": "m", "Frau": "f", "Monsieur": "m", "Madame": "f", "Mme": "f", "Mlle": "f",
    "Sr": "m", "Sra": "f", "Señor": "m", "Señora": "f", "Don": "m", "Doña": "f",
    "господин": "m", "госпожа": "f", "г-н": "m", "г-жа": "f",
}
# Common given names by gender.
GIVEN = {
    "f": "Mary Patricia Jennifer Linda Elizabeth Barbara Susan Jessica Sarah Karen Emily Emma Olivia Sophie Julia Anna Maria Laura "
         "Claire Camille Chloé Marie Isabelle Petra Sabine Ursula Heike Monika Carmen Lucía Sofía Elena Isabel Ana Jane Alice "
         "Agnieszka Małgorzata Katarzyna Zofia Tereza Kateřina Ayşe "
         "Анна Мария Елена Ольга Наталья Татьяна Ирина",
    "m": "James Robert John Michael David William Richard Joseph Thomas Charles Daniel Matthew Peter Paul Mark George Henry Jack "
         "Pierre Jean Jacques Louis Hans Klaus Jürgen Stefan Wolfgang Günter Carlos José Juan Luis Miguel Javier Alejandro Bob "
         "Łukasz Paweł Michał Krzysztof Jiří Ondřej Mehmet "
         "Иван Сергей Алексей Дмитрий Андрей Михаил Николай",
}
GENDER = {name: g for g, names in GIVEN.items() for name in names.split()}

# Letters of the Latin script (with Extended-A, -B and Additional) and of the Cyrillic one.
_LETTERS = [chr(c) for r in (range(0xC0, 0x250), range(0x400, 0x500), range(0x1E00, 0x1F00)) for c in r]
_UP = "A-Z" + "".join(c for c in _LETTERS if c.isupper())
_LOW = "a-z" + "".join(c for c in _LETTERS if c.islower())
_CAPITAL = rf"(?:[{_UP}]['’])?(?:[{_UP}][{_LOW}]+)+"
_NAME = rf"{_CAPITAL}(?:-{_CAPITAL})?"
_INITIALS = rf"(?:[{_UP}](?:\.[ \t]*|[ \t]+)){{0,3}}"
# Parts of patterns: a secret's characters, and what stands between a call word and a bare number.
_SECRET = r"[\w+/!@#$%^*?~-]"
_CALL = (r"(?i:\b(?:call|phone|tel|telephone|mobile|cell|fax|dial|ring|text|sms|whatsapp|contact|telefon|handy|mobil|rufnummer|ruf|fon"
         r"|téléphone|tél|portable|appelez|teléfono|móvil|llame|llamar|телефон|тел|звоните|позвоните|моб)\b"
         r"(?:[^\w\n+]{1,3}(?:me|us|him|her|them|at|on|is|no|nr|number|now|today|the|my|our|us|unter|au|le|al|по)\b){0,3}[^\w\n+]{1,3})")
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
# Kinds in order of precedence; group "v" is the value where the match holds more.
PATTERNS = [(kind, re.compile(pattern)) for kind, pattern in (
    ("email", r"(?<![\w.%+-])[\w%+-]+(?:\.[\w%+-]+)*@[\w-]+(?:\.[\w-]+)*\.[^\W\d_]{2,}(?![\w@-])"),
    ("secret", r"(?:\b|_|(?<=[a-z0-9])(?=[A-Z]))(?i:password|passwd|passphrase|pwd|token|secret|(?:api|access|secret|private)[_-]?key)[\"']?\s*[=:]\s*[\"']?"
               rf"(?P<v>(?=(?:[^\sA-Za-z0-9]*[A-Za-z0-9]){{4}})(?=(?:{_SECRET}|&(?!\w+=)|\.(?={_SECRET})){{8}})(?:{_SECRET}|&(?!\w+=)|\.(?={_SECRET}))+={{0,2}})"),
    ("access_key", r"\b(?:AKIA|ASIA)(?P<v>[0-9A-Z]{16})\b"),
    ("iban", r"\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}\b"),
    ("card", r"(?<![\d+.-])\d(?:[ -]?\d){12,18}(?![\d-]|\.\d)"),
    ("ssn", r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"),
    ("ipv6", r"(?<![:\w])(?:[0-9a-fA-F]{1,4}:){7}[0-9a-fA-F]{1,4}(?![:\w])"),
    ("ipv4", rf"(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\.?\d)"),
    ("phone", r"(?<![\w+.-])(?:\+\d{1,3}[ .-]?)?(?:\(\d{2,5}\)[ .-]?|\d{2,5}[ .-])\d{2,4}(?:[ .-]\d{2,4}){1,3}(?![\w-]|\.\d)"),
    ("phone", r"(?<![\w+.-])\+\d{8,15}(?!\w)"),
    ("phone", r"(?<![\w+.-])\+\d{1,3}(?:[ .-]?\(\d{1,5}\))?(?:[ ./-]?\d)+(?![\w-]|\.\d)"),
    ("phone", r"(?<![\w+./-])\(?0\d{1,5}\)?(?:[ -]|[ ]?/[ ]?)\d{5,9}(?![\w-]|\.\d)"),
    ("phone", rf"{_CALL}(?P<v>\d{{9,12}})(?![\w-]|\.\d)"),
)]
# Cards and IBANs beside other digits or capitals are looked for in the whole run, at its group borders.
_DIGIT_RUN = re.compile(r"(?<![\d+.-])\d(?:[ -]?\d){12,}(?![\d-]|\.\d)")
_IBAN_RUN = re.compile(r"(?=(\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]){11,30}))")
# Prefixes and lengths of the card issuers (Visa, Mastercard, Amex, Diners, JCB, Maestro and others of 5 and 6, Mir, Troy).
_ISSUED = re.compile(r"4(?:\d{12}|\d{15}|\d{18})|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3(?:0[0-5]|[689]\d)\d{11,16}|35\d{14,17}"
                     r"|(?:5[06-8]|6\d|8[12])\d{11,17}|220[0-4]\d{12,15}|9792\d{12}")
# Length of an IBAN by country.
IBAN_LENGTHS = {word[:2]: int(word[2:]) for word in (
    "AD24 AE23 AL28 AT20 AZ28 BA20 BE16 BG22 BH22 BI27 BR29 BY28 CH21 CR22 CY28 CZ24 DE22 DJ27 DK18 DO28 EE20 EG29 ES24 FI18 FK18 "
    "FO18 FR27 GB22 GE22 GI23 GL18 GR27 GT28 HR21 HU28 IE22 IL23 IQ23 IS26 IT27 JO30 KW30 KZ20 LB28 LC32 LI21 LT20 LU20 LV21 LY25 "
    "MC27 MD24 ME22 MK19 MN20 MR27 MT31 MU30 NI28 NL18 NO15 OM23 PK24 PL28 PS29 PT25 QA29 RO24 RS22 RU33 SA24 SC31 SD18 SE24 SI19 "
    "SK24 SM27 SO23 ST25 SV28 TL23 TN24 TR26 UA29 VA22 VG24 XK20 YE30").split()}
# Digits of an international number by country code, where the plan has one length.
PHONE_LENGTHS = {"1": 11, "7": 11, "33": 11, "34": 11, "48": 11}
_TITLED = re.compile(rf"\b({'|'.join(map(re.escape, TITLES))})\.?[ \t]+({_INITIALS}{_NAME}(?:[ \t]+{_INITIALS}{_NAME}){{0,2}})")
_KNOWN = re.compile(rf"\b({'|'.join(GENDER)})[ \t]+{_INITIALS}({_NAME})\b")
# A word that can be a name found elsewhere in the text: as written there, or in capitals.
_BARE = re.compile(rf"(?<!\w)(?:{_NAME}|(?:[{_UP}]['’])?[{_UP}]{{2,}}(?:-[{_UP}]{{2,}})?)(?!\w)")
_BARE_PART = re.compile(rf"{_CAPITAL}|(?:[{_UP}]['’])?[{_UP}]{{2,}}")
# Cheap signs that a text can hold values of the patterns, or a name.
_DIGIT = re.compile(r"[\d@]")
_BEFORE_CAPITAL = re.compile(rf"([{_UP}][\w-]*)\.?(?=[ \t]+[{_UP}])")
_LOWER_TITLES = tuple(t for t in TITLES if t[0].islower())


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(doubled)) % 10 == 0


def iban_rest(value: str) -> int:
    moved = value[4:] + value[:4]
    return int("".join(str(int(c, 36)) for c in moved)) % 97


def _script(word: str) -> str:
    return "cyrillic" if "Ѐ" <= word[0] <= "ӿ" else "latin"


def _canonical(kind: str, surface: str) -> str | None:
    """The value a mention stands for, or None if it is not valid for its kind."""
    if kind == "email":
        return surface.lower()
    if kind == "card":
        digits = re.sub(r"\D", "", surface)
        return digits if luhn(digits) and len(set(digits)) > 1 else None
    if kind == "iban":
        plain = surface.replace(" ", "")
        return plain if 15 <= len(plain) <= 34 and iban_rest(plain) == 1 else None
    if kind == "phone":
        plain = re.sub(r"[^\d+]", "", surface)
        return plain if 7 <= len(plain.lstrip("+")) <= 15 and (surface[0] in "+(" or len(plain) >= 9) else None
    if kind == "ipv6":
        return surface.lower()
    return surface


Mention = tuple[int, int, str, str]       # start, stop, kind, canonical value


def _card_stretches(text: str) -> Iterator[tuple[int, int]]:
    """Valid cards that begin and end at group borders of a run of digits, without overlaps.

    A group of 13 to 19 digits needs the check digit alone, several groups also
    an issuer's prefix and length: of all stretches of a table of numbers a
    tenth pass the check digit.
    """
    for run in _DIGIT_RUN.finditer(text):
        groups = [(run.start() + m.start(), run.start() + m.end()) for m in re.finditer(r"\d+", run.group())]
        found = []
        for i, (a, _) in enumerate(groups):
            digits = ""
            for j in range(i, len(groups)):
                digits += text[slice(*groups[j])]
                if len(digits) > 19:
                    break
                issued = len(digits) >= 13 and _ISSUED.fullmatch(digits) is not None
                if len(digits) >= 13 and (issued or i == j) and _canonical("card", digits):
                    found.append((not issued, i != j, -len(digits), a, groups[j][1]))
        yield from _apart([(a, b) for *_, a, b in sorted(found)])


def _iban_stretches(text: str) -> Iterator[tuple[int, int]]:
    """Valid IBANs at group borders: of their country's length, or the longest that passes where no length is known."""
    for run in _IBAN_RUN.finditer(text):
        a, ends = run.start(), []
        plain = 0
        for b, c in enumerate(run.group(1), a + 1):
            plain += c != " "
            if plain >= 15 and c != " " and not re.match(r"\w", text[b:b + 1]):
                ends.append((plain, b))
        length = IBAN_LENGTHS.get(text[a:a + 2])
        for plain, b in reversed(ends):
            if length in (None, plain) and _canonical("iban", text[a:b]):
                yield a, b
                break


def _phone_end(text: str, a: int, b: int) -> int:
    """Where an international number ends whose match took in groups beside it: at its plan's length, else at 15 digits."""
    if text[a] != "+":
        return b
    ends, plain = [], 0
    for at in range(a + 1, b):
        if text[at].isdigit():
            plain += 1
            if at + 1 == b or not text[at + 1].isdigit():
                ends.append((plain, at + 1))
    length = next((n for code, n in PHONE_LENGTHS.items() if text.startswith(code, a + 1)), None)
    return next((e for n, e in ends if n == length), max((e for n, e in ends if n <= 15), default=b))


def _apart(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """The spans that overlap none before them in the list."""
    starts: list[int] = []
    kept: list[tuple[int, int]] = []
    for a, b in spans:
        k = bisect_left(starts, b)
        if not k or kept[k - 1][1] <= a:
            starts.insert(k, a)
            kept.insert(k, (a, b))
    return kept


def _plain(name: str) -> str:
    return name.lower().replace("’", "'")


def _names(text: str) -> Iterator[Mention]:
    def parts(words: str, offset: int, gender: str) -> Iterator[Mention]:
        found = list(re.finditer(_NAME, words))
        if gender == "n" and len(found) > 1:
            gender = GENDER.get(found[0].group(), "n")
        for k, m in enumerate(found):
            word, script = m.group(), _script(m.group())
            if k < len(found) - 1:
                kind = f"given:{GENDER.get(word, gender)}:{script}"
            else:
                kind = f"surname:{gender if script == 'cyrillic' else 'n'}:{script}"
            yield offset + m.start(), offset + m.end(), kind, _plain(word)

    for m in _TITLED.finditer(text):
        yield from parts(m.group(2), m.start(2), TITLES[m.group(1)])
    for m in _KNOWN.finditer(text):
        yield from parts(m.group(), m.start(), GENDER[m.group(1)])


def _again(text: str, found: list[tuple]) -> Iterator[Mention]:
    """Other places of the names and secrets found in a text: bare given names and surnames, values without their keyword."""
    names: dict[str, str] = {}
    secrets: set[str] = set()
    for *_, kind, canonical in sorted(found, key=lambda f: (f[0], f[2])):
        if ":" in kind:
            names.setdefault(canonical, kind)
        elif kind == "secret" and any(c.isdigit() for c in canonical):
            secrets.add(canonical)
    if names:
        for m in _BARE.finditer(text):
            whole = [m] if _plain(m.group()) in names else _BARE_PART.finditer(text, m.start(), m.end())
            yield from ((p.start(), p.end(), names[_plain(p.group())], _plain(p.group())) for p in whole if _plain(p.group()) in names)
    for value in secrets:
        for m in re.finditer(rf"(?<!\w){re.escape(value)}(?!\w)", text):
            yield m.start(), m.end(), "secret", value


def detect(text: str | None) -> list[Mention]:
    """All mentions of a text, without overlaps, in order of place."""
    if not text:
        return []
    found = []
    digit = _DIGIT.search(text) is not None
    assigned = "=" in text or ":" in text
    for rank, (kind, pattern) in enumerate(PATTERNS):
        if not (assigned if kind == "secret" else digit or (kind == "access_key" and ("AKIA" in text or "ASIA" in text))):
            continue
        for m in pattern.finditer(text):
            group = "v" if "v" in pattern.groupindex else 0
            a, b = m.span(group)
            if kind == "phone":
                b = _phone_end(text, a, b)
            canonical = _canonical(kind, text[a:b])
            if canonical is not None:
                found.append((a, b, rank, kind, canonical))
        if kind in ("card", "iban"):
            spans = _card_stretches(text) if kind == "card" else _iban_stretches(text)
            found += [(a, b, rank - 0.5, kind, _canonical(kind, text[a:b])) for a, b in spans]      # before whole matches
    if any(m.group(1) in TITLES or m.group(1) in GENDER for m in _BEFORE_CAPITAL.finditer(text)) or any(t in text for t in _LOWER_TITLES):
        found += [(a, b, len(PATTERNS), kind, c) for a, b, kind, c in _names(text)]
    if found:
        found += [(a, b, len(PATTERNS) + 1, kind, c) for a, b, kind, c in _again(text, found)]
    named = {}
    for a, b, _, kind, canonical in sorted(found, key=lambda f: (f[2], f[0], -f[1])):
        named.setdefault((a, b), (a, b, kind, canonical))
    return [named[span] for span in _apart(list(named))]


class _Stream:
    """Numbers drawn from HMAC-SHA256(key, kind, value, attempt)."""

    def __init__(self, key: bytes, kind: str, value: str, attempt: int):
        self.key, self.seed, self.block, self.pool = key, f"{kind}\0{value}\0{attempt}".encode(), 0, b""

    def below(self, n: int) -> int:
        while len(self.pool) < 4:
            self.pool += hmac.new(self.key, self.seed + self.block.to_bytes(4, "big"), hashlib.sha256).digest()
            self.block += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value % n

    def pick(self, options: str | list[str]) -> str:
        return options[self.below(len(options))]


LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Syllables that surrogate names are made of, and endings by gender.
SYLLABLES = {
    "latin": (["Ba", "Ca", "Da", "Fe", "Ga", "Ha", "Ja", "Ka", "Le", "Ma", "Ne", "Pa", "Ro", "Sa", "Te", "Va", "Wi", "Za", "Bri", "Cla"],
              ["be", "di", "lo", "mi", "na", "re", "ri", "sa", "ta", "ve", "lin", "mar", "nor", "tel", "vin", "dor", "gan", "ker", "lem", "sen"]),
    "cyrillic": (["Ба", "Ва", "Га", "Да", "Жу", "За", "Ка", "Ла", "Ма", "Не", "Пе", "Ро", "Са", "Та", "Фе", "Ши"],
                 ["бе", "ви", "до", "ли", "ми", "на", "ре", "ро", "са", "та", "ве", "мар", "лин", "кан", "дор", "тел"]),
}
ENDINGS = {
    ("given", "f", "latin"): ["a", "ia", "ina", "elle", "ette"], ("given", "m", "latin"): ["o", "an", "er", "us", "on"],
    ("given", "n", "latin"): ["y", "is", "ey", "in"], ("surname", "n", "latin"): ["son", "man", "ard", "ini", "ez", "er", "well", "berg"],
    ("given", "f", "cyrillic"): ["на", "ья", "ия"], ("given", "m", "cyrillic"): ["ан", "ий", "ей"], ("given", "n", "cyrillic"): ["ша"],
    ("surname", "f", "cyrillic"): ["ова", "ева", "ина"], ("surname", "m", "cyrillic"): ["ов", "ев", "ин"],
    ("surname", "n", "cyrillic"): ["енко", "ых", "дзе"],
}


def _shape(value: str, draw: _Stream) -> str:
    """Letters for letters, digits for digits, hexadecimal for hexadecimal; other characters stay."""
    hexadecimal = re.fullmatch(r"[0-9a-f]+", value) is not None and any(c.isdigit() for c in value)
    out = []
    for c in value:
        if hexadecimal:
            out.append(draw.pick("0123456789abcdef"))
        elif c.isdigit():
            out.append(draw.pick(DIGITS))
        elif c.isalpha():
            out.append(draw.pick(UPPER if c.isupper() else LOWER))
        else:
            out.append(c)
    return "".join(out)


def surrogate(kind: str, value: str, attempt: int, key: bytes) -> str:
    """The keyed replacement of a canonical value, itself a canonical value of the kind."""
    draw = _Stream(key, kind, value, attempt)
    if ":" in kind:
        part, gender, script = kind.split(":")
        first, middle = SYLLABLES[script]
        length = 1 + draw.below(2) + attempt // 10       # longer names when short ones run out
        return (draw.pick(first) + "".join(draw.pick(middle) for _ in range(length)) + draw.pick(ENDINGS[part, gender, script])).lower()
    if kind == "email":
        local, domain = value.split("@")
        labels = domain.split(".")
        hosts = [_shape(x, draw) for x in labels[:-2]]
        return f"{_shape(local, draw)}@{'.'.join([*hosts, 'example', labels[-1]])}"
    if kind == "card":
        body = value[0] + "".join(draw.pick(DIGITS) for _ in value[1:-1])
        return body + next(d for d in DIGITS if luhn(body + d))
    if kind == "iban":
        body = "".join(draw.pick(DIGITS if c.isdigit() else UPPER) for c in value[4:])
        return f"{value[:2]}{98 - iban_rest(value[:2] + '00' + body):02d}{body}"
    if kind == "phone":
        plus = re.match(r"\+(?:1|7|[2-9]\d)", value)
        head = plus.group() if plus and len(value) - plus.end() >= 6 else ""
        rest = value[len(head):]
        body = "".join(draw.pick(DIGITS if k or not head else DIGITS[2:]) if c != "+" else c for k, c in enumerate(rest))
        return head + (body[:3] + "555" + body[6:] if len(rest) == 10 and rest[3:6] == "555" else body)
    if kind == "ssn":
        return f"9{draw.below(100):02d}-{1 + draw.below(99):02d}-{1 + draw.below(9999):04d}"    # the 9xx area is never issued
    if kind == "ipv4":
        private = next((p for p in ("10.", "192.168.", "127.") if value.startswith(p)), "")
        kept = private.count(".")
        return private + ".".join(str(1 + draw.below(222 if k == 0 and not kept else 254)) for k in range(4 - kept))
    if kind == "ipv6":
        return ":".join(["2001", "db8", *(f"{draw.below(65536):x}" for _ in range(6))])
    if kind == "secret":
        return _shape(value, draw) + "".join(draw.pick(DIGITS) for _ in range(attempt // 10))      # longer when few characters can change
    return _shape(value, draw)


def written(kind: str, surface: str, value: str) -> str:
    """A surrogate in the form of a mention: its separators and letter case."""
    if kind in ("card", "iban", "phone"):
        symbols = iter(value)
        return "".join(next(symbols, "") if c.isalnum() or c == "+" else c for c in surface)
    if kind == "email" and surface.isupper():
        return value.upper()
    if ":" in kind:
        return value.upper() if surface.isupper() else value.title()
    return value


def _draw(values: DataFrame, key: bytes) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [surrogate(k, c, a, key) for k, c, a in zip(*[batch.column(n).to_pylist() for n in ("kind", "canonical", "attempt")])]
            yield pa.record_batch([batch.column("kind"), batch.column("canonical"), batch.column("attempt"), pa.array(rows, pa.string())],
                                  names=["kind", "canonical", "attempt", "surrogate"])
    return values.select("kind", "canonical", "attempt").mapInArrow(run, "kind string, canonical string, attempt int, surrogate string")


def surrogates(values: DataFrame, key: bytes) -> DataFrame:
    """``values(kind, canonical)`` distinct -> one ``surrogate`` each, distinct per kind and none a real value."""
    left = values.select("kind", "canonical", F.lit(0).alias("attempt"))
    real = values.select("kind", F.col("canonical").alias("surrogate"))
    settled: DataFrame | None = None
    for _ in range(ATTEMPTS):
        drawn = materialise(_draw(left, key), "pii-drawn")
        taken = real if settled is None else real.unionByName(settled.select("kind", "surrogate"))
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        first = materialise(free.withColumn("turn", F.row_number().over(Window.partitionBy("kind", "surrogate").orderBy("canonical")))
                            .where("turn = 1").select("kind", "canonical", "surrogate"), "pii-settled")
        settled = first if settled is None else settled.unionByName(first)
        left = materialise(drawn.join(first, ["kind", "canonical"], "left_anti")
                           .select("kind", "canonical", (F.col("attempt") + 1).alias("attempt")), "pii-open")
        if left.isEmpty():
            return settled
    raise ValueError("no free surrogates left for some values")


def replace_pii(docs: DataFrame, key: bytes, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with its text rewritten: id, ``n_entities``, ``text`` and ``entities`` (kind, start, stop in the new text)."""
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.xxhash64(text_col).alias("text_hash"))

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            out = [(h, a, b, kind, c, text[a:b])
                   for h, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()) for a, b, kind, c in detect(text)]
            columns = list(zip(*out)) if out else [[]] * 6
            kinds = (pa.int64(), pa.int32(), pa.int32(), pa.string(), pa.string(), pa.string())
            yield pa.record_batch([pa.array(c, t) for c, t in zip(columns, kinds)],
                                  names=["text_hash", "start", "stop", "kind", "canonical", "surface"])

    # Equal texts have equal mentions: they are found per row, and kept once per text.
    mentions = materialise(rows.select("text_hash", "text").mapInArrow(
        find, "text_hash long, start int, stop int, kind string, canonical string, surface string").distinct(), "pii-mentions")
    values = materialise(mentions.select("kind", "canonical").distinct(), "pii-values")
    table = materialise(surrogates(values, key), "pii-surrogates")
    placed = mentions.join(table, ["kind", "canonical"]).groupBy("text_hash").agg(F.sort_array(F.collect_list(
        F.struct("start", "stop", "kind", "surface", "surrogate"))).alias("found"))
    joined = rows.join(materialise(placed, "pii-places"), "text_hash", "left").select("id", "text", "found")

    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))

    def rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            texts, counts, places = [], [], []
            for text, found in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist()):
                out, at, spans, length = [], 0, [], 0
                for m in found or []:
                    if text[m["start"]:m["stop"]] != m["surface"]:
                        raise ValueError("two texts share a hash")
                    new = written(m["kind"], m["surface"], m["surrogate"])
                    out += [text[at:m["start"]], new]
                    length += m["start"] - at + len(new)
                    spans.append({"kind": m["kind"].split(":")[0], "start": length - len(new), "stop": length})
                    at = m["stop"]
                texts.append(text if not spans else "".join(out) + text[at:])
                counts.append(len(spans))
                places.append(spans)
            yield pa.record_batch([batch.column(0), pa.array(counts, pa.int64()), pa.array(texts, pa.string()), pa.array(places, span)],
                                  names=["id", "n_entities", "text", "entities"])

    kind = docs.schema[id_col].dataType.simpleString()
    return joined.mapInArrow(rewrite, f"id {kind}, n_entities long, text string, entities array<struct<kind:string,start:long,stop:long>>") \
        .withColumnRenamed("id", id_col)
