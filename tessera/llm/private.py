"""Format-preserving pseudonyms for private data, with DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm.scratch import free

ROUNDS = 8
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
#: One alternative per kind, in order of precedence. No alternative can start within a word, so none rescans one.
KINDS = {
    "email": r"(?<![\p{L}0-9._%+\-])[\p{L}0-9._%+\-]{1,64}@(?:[A-Za-z0-9\-]{1,63}\.){1,8}[A-Za-z]{2,24}",
    "secret": r"(?<![A-Za-z0-9])(?:AKIA[0-9A-Z]{16}|gh[pousr]_[A-Za-z0-9]{36}|sk_live_[A-Za-z0-9]{16,64})(?![A-Za-z0-9])"
    r"|(?<![A-Za-z0-9])(?i:token|secret|password|passwd|api_?key)\s{0,3}[=:]\s{0,3}[\"']?[A-Za-z0-9_+/\-]{8,128}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "date": r"(?<![\w./\-])(?:\d{4}-\d{2}-\d{2}|\d{1,2}/\d{1,2}/\d{4}|\d{1,2}\.\d{1,2}\.\d{4})(?![\w/\-]|\.\d)",
    "ip": rf"(?<![\w.])(?:{_OCTET}\.){{3}}{_OCTET}(?![\w]|\.\d)",
    "card": r"(?<![\w.\-])\d(?:[ \-]?\d){12,18}(?![\w\-])",
    "ssn": r"(?<![\w\-])\d{3}-\d{2}-\d{4}(?![\w\-])",
    "phone": r"(?<![\w.])(?:\+\d{1,3}[ .\-]?)?(?:\(\d{2,4}\)[ .\-]?|\d{2,4}[ .\-])\d{3,4}[ .\-]?\d{3,4}(?![\w])|(?<![\w.])\+\d{8,14}(?!\w)",
}
PATTERN = "|".join(f"(?:{p})" for p in KINDS.values())


def _number(hexadecimal: Column) -> Column:
    return F.conv(hexadecimal, 16, 10).cast("long")


def _draw(key: str, *parts: Column) -> Column:
    return F.sha2(F.concat_ws("|", F.lit(key), *[p.cast("string") for p in parts]).cast("binary"), 512)


def feistel_pair(key: str, kind: str, x: Column, x_size: int, y: Column, y_size: int) -> Column:
    """A keyed permutation of the pairs ``0 <= x < x_size, 0 <= y < y_size``, as ``struct<x, y>``."""
    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))

    def turn(state: Column, k: Column) -> Column:
        by_y = _number(F.substring(_draw(key, F.lit(kind), k, state["y"]), 1, 12))
        by_x = _number(F.substring(_draw(key, F.lit(kind), k, state["x"]), 1, 12))
        even = k % 2 == 0
        return F.struct(
            F.when(even, (state["x"] + by_y) % x_size).otherwise(state["x"]).alias("x"),
            F.when(even, state["y"]).otherwise((state["y"] + by_x) % y_size).alias("y"),
        )

    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)


#: First and last of runs of code points that are all letters, of the scripts most in use.
LETTERS = [
    (0x00C0, 0x00D6), (0x00D8, 0x00F6), (0x00F8, 0x00FF), (0x0100, 0x024F), (0x0391, 0x03A1), (0x03A3, 0x03CE),
    (0x0400, 0x0481), (0x0531, 0x0556), (0x0561, 0x0587), (0x05D0, 0x05EA), (0x0620, 0x064A), (0x0904, 0x0939),
    (0x0E01, 0x0E30), (0x10D0, 0x10FA), (0x3041, 0x3096), (0x30A1, 0x30FA), (0x4E00, 0x9FFF), (0xAC00, 0xD7A3),
]


def _wide(c: Column, by: Column) -> Column:
    """A letter beyond ASCII, moved within its run of letters; of one outside all runs, a small letter."""
    code = F.ascii(c)
    new = F.when(F.lit(False), code)
    for low, high in LETTERS:
        new = new.when(c.between(chr(low), chr(high)), F.lit(low) + (code - low + by) % (high - low + 1))
    return F.coalesce(F.decode(F.unhex(F.lpad(F.hex(new), 4, "0")), "UTF-16BE"), F.char(97 + by % 26))


def feistel_text(key: str, kind: Column, text: Column, wide: bool = False) -> Column:
    """A keyed permutation of the strings with the same digits, capitals and small letters in the same places.

    With ``wide``, letters beyond ASCII are permuted within their script's run of letters; those of scripts without a
    run become small letters, which can't be inverted."""
    half = F.floor(F.length(text) / 2).cast("int")
    start = F.struct(F.substr(text, F.lit(1), half).alias("a"), F.substr(text, half + 1).alias("b"))

    def shifted(part: Column, draw: Column) -> Column:
        def one(c: Column, i: Column) -> Column:
            by = _number(F.substr(draw, (i % 42) * 3 + 1, F.lit(3))).cast("int")
            code = F.ascii(c)
            turned = lambda low, size: F.char(F.lit(low) + (code - low + by) % size)
            return F.when(c.between("0", "9"), turned(48, 10)).when(c.between("a", "z"), turned(97, 26)).when(c.between("A", "Z"), turned(65, 26)).otherwise(_wide(c, by) if wide else c)

        return F.when(F.length(part) == 0, part).otherwise(F.array_join(F.transform(F.split(part, ""), one), ""))

    def turn(state: Column, k: Column) -> Column:
        even = k % 2 == 0
        own, other = F.when(even, state["a"]).otherwise(state["b"]), F.when(even, state["b"]).otherwise(state["a"])
        # The array binds what is used many times: each is computed once.
        new = F.transform(F.array(F.struct(own.alias("own"), _draw(key, kind, k, other).alias("draw"))), lambda z: shifted(z["own"], z["draw"]))[0]
        return F.struct(F.when(even, new).otherwise(state["a"]).alias("a"), F.when(even, state["b"]).otherwise(new).alias("b"))

    done = F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, turn)
    return F.transform(F.array(done), lambda z: F.concat(z["a"], z["b"]))[0]


def _digits(text: Column) -> Column:
    return F.regexp_replace(text, "[^0-9]", "")


def refilled(shape: Column, values: Column, slots: str) -> Column:
    """``shape`` with the characters that match ``slots`` replaced by those of ``values``, one after the other."""
    state = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))

    def put(s: Column, c: Column) -> Column:
        hit = c.rlike(slots)
        return F.struct(F.concat(s["out"], F.when(hit, F.substr(values, s["at"] + 1, F.lit(1))).otherwise(c)).alias("out"), (s["at"] + hit.cast("int")).alias("at"))

    return F.aggregate(F.split(shape, ""), state, put, lambda s: s["out"])


def luhn_sum(digits: Column, doubled_from_last: int) -> Column:
    """Sum of the Luhn rule; ``doubled_from_last`` 1 doubles the last digit, 0 the one before it."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = F.when(d > 4, 2 * d - 9).otherwise(2 * d)
        return total + F.when((n - i + doubled_from_last) % 2 == 1, twice).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def is_card(match: Column) -> Column:
    return luhn_sum(_digits(match), 0) % 10 == 0


def _card(key: str, match: Column) -> Column:
    def made(z: Column) -> Column:
        body = F.concat(F.substr(z, F.lit(1), F.lit(1)), feistel_text(key, F.lit("card"), F.substr(z, F.lit(2), F.length(z) - 2)))
        return F.transform(F.array(body), lambda b: F.concat(b, ((10 - luhn_sum(b, 1) % 10) % 10).cast("string")))[0]

    number = F.transform(F.array(_digits(match)), made)[0]
    return refilled(match, number, "[0-9]")


def _mod97(text: Column) -> Column:
    """Of the number in which letters stand for 10 to 35."""

    def add(rest: Column, c: Column) -> Column:
        return F.when(c.between("0", "9"), (rest * 10 + c.cast("int")) % 97).otherwise((rest * 100 + F.ascii(c) - 55) % 97)

    return F.aggregate(F.split(text, ""), F.lit(0), add)


def is_iban(match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    return F.length(plain).between(15, 34) & (_mod97(F.concat(F.substr(plain, F.lit(5)), F.substr(plain, F.lit(1), F.lit(4)))) == 1)


def _iban(key: str, match: Column) -> Column:
    plain = F.replace(match, F.lit(" "), F.lit(""))
    country = F.substr(plain, F.lit(1), F.lit(2))

    def made(body: Column) -> Column:
        check = F.lpad((98 - _mod97(F.concat(body, country, F.lit("00")))).cast("string"), 2, "0")
        return F.concat(country, check, body)

    number = F.transform(F.array(feistel_text(key, F.lit("iban"), F.substr(plain, F.lit(5)))), made)[0]
    return refilled(match, number, "[A-Z0-9]")


def is_ssn(match: Column) -> Column:
    area = F.substr(match, F.lit(1), F.lit(3)).cast("int")
    return area.between(1, 899) & (area != 666) & (F.substr(match, F.lit(5), F.lit(2)) != "00") & (F.substr(match, F.lit(8), F.lit(4)) != "0000")


def _ssn(key: str, match: Column) -> Column:
    area = F.substr(match, F.lit(1), F.lit(3)).cast("int")
    x = F.when(area > 666, area - 2).otherwise(area - 1)
    y = (F.substr(match, F.lit(5), F.lit(2)).cast("int") - 1) * 9999 + F.substr(match, F.lit(8), F.lit(4)).cast("int") - 1

    def made(z: Column) -> Column:
        new = F.when(z["x"] >= 665, z["x"] + 2).otherwise(z["x"] + 1)
        return F.concat_ws("-", F.lpad(new.cast("string"), 3, "0"), F.lpad((F.floor(z["y"] / 9999) + 1).cast("string"), 2, "0"), F.lpad((z["y"] % 9999 + 1).cast("string"), 4, "0"))

    return F.transform(F.array(feistel_pair(key, "ssn", x, 898, y, 989_901)), made)[0]


def _ip(key: str, match: Column) -> Column:
    part = lambda i: F.split_part(match, F.lit("."), F.lit(i)).cast("int")

    def made(z: Column) -> Column:
        return F.concat_ws(".", *[x.cast("string") for x in (F.floor(z["x"] / 256), z["x"] % 256, F.floor(z["y"] / 256), z["y"] % 256)])

    return F.transform(F.array(feistel_pair(key, "ip", part(1) * 256 + part(2), 65536, part(3) * 256 + part(4), 65536)), made)[0]


def _day(match: Column) -> Column:
    """The date a match states, null if it states none; with slashes the month comes first where it can."""
    a, b = F.regexp_extract(match, r"^(\d+)\D(\d+)\D(\d+)$", 1).cast("int"), F.regexp_extract(match, r"^(\d+)\D(\d+)\D(\d+)$", 2).cast("int")
    year = F.regexp_extract(match, r"(\d{4})$", 1)
    iso = lambda y, m, d: F.try_to_date(F.concat_ws("-", y, F.lpad(m.cast("string"), 2, "0"), F.lpad(d.cast("string"), 2, "0")), "yyyy-MM-dd")
    dotted = match.contains(".")
    return F.when(match.rlike(r"^\d{4}-"), F.try_to_date(match, "yyyy-MM-dd")).when(~dotted & (a <= 12), iso(year, a, b)).otherwise(iso(year, b, a))


#: 400 years of the calendar, 146,097 days, are the pairs of 189 and 773 numbers.
FIRST_DAY, DAYS_X, DAYS_Y = "1800-01-01", 189, 773


def is_date(match: Column) -> Column:
    return F.coalesce(F.datediff(_day(match), F.lit(FIRST_DAY).cast("date")).between(0, DAYS_X * DAYS_Y - 1), F.lit(False))


def _date(key: str, match: Column) -> Column:
    n = F.datediff(_day(match), F.lit(FIRST_DAY).cast("date"))
    a = F.regexp_extract(match, r"^(\d+)\D", 1).cast("int")

    def made(z: Column) -> Column:
        day = F.date_add(F.lit(FIRST_DAY).cast("date"), (z["x"] * DAYS_Y + z["y"]).cast("int"))
        shown = lambda form: F.date_format(day, form)
        # Day first stays readable as day first: a day over 12 can't be taken for a month, others read alike.
        return F.when(match.contains("-"), shown("yyyy-MM-dd")).when(match.contains("."), shown("dd.MM.yyyy")).when(a <= 12, shown("MM/dd/yyyy")).otherwise(shown("dd/MM/yyyy"))

    return F.transform(F.array(feistel_pair(key, "date", F.floor(n / DAYS_Y), DAYS_X, n % DAYS_Y, DAYS_Y)), made)[0]


def _some(key: str, kind: str, match: Column, fixed: str) -> Column:
    """Letters and digits after ``fixed``, a pattern for what stays in front."""
    front = F.regexp_extract(match, f"^({fixed})", 1)
    rest = F.substr(match, F.length(front) + 1)
    return F.concat(front, refilled(rest, feistel_text(key, F.lit(kind), F.regexp_replace(rest, "[^A-Za-z0-9]", "")), "[A-Za-z0-9]"))


def _email(key: str, match: Column) -> Column:
    end = F.regexp_extract(match, r"(\.[A-Za-z]+)$", 1)
    rest = F.substr(match, F.lit(1), F.length(match) - F.length(end))
    return F.concat(refilled(rest, feistel_text(key, F.lit("email"), F.regexp_replace(rest, r"[^\p{L}0-9]", ""), wide=True), r"[\p{L}0-9]"), end)


def kind_of(match: Column) -> Column:
    """Of a match of PATTERN; null for one that its rule refuses, such as a number that isn't a card's."""
    whole = lambda kind: match.rlike(f"^(?:{KINDS[kind]})$")
    return (
        F.when(match.contains("@"), "email")
        .when(whole("secret"), "secret")
        .when(match.rlike("^[A-Z]{2}"), F.when(is_iban(match), "iban"))
        .when(whole("date"), F.when(is_date(match), "date"))
        .when(whole("ip"), "ip")
        .when(whole("card") & is_card(match), "card")
        .when(whole("ssn"), F.when(is_ssn(match), "ssn"))
        .when(whole("phone"), "phone")
    )


def pseudonym(key: str, match: Column, kind: Column) -> Column:
    return (
        F.when(kind == "email", _email(key, match))
        .when(kind == "secret", _some(key, "secret", match, r"AKIA|gh[pousr]_|sk_live_|[A-Za-z_]+\s*[=:]\s*[\"']?"))
        .when(kind == "iban", _iban(key, match))
        .when(kind == "date", _date(key, match))
        .when(kind == "ip", _ip(key, match))
        .when(kind == "card", _card(key, match))
        .when(kind == "ssn", _ssn(key, match))
        .when(kind == "phone", _some(key, "phone", match, r"(?:\+\d{1,3}(?=[ .\-(]))?"))
        .otherwise(match)
    )


def pseudonymize(docs: DataFrame, key: str) -> DataFrame:
    """``docs`` with private data in ``text`` replaced, and ``private``, its ``(kind, pseudonym)`` in order.

    Found are e-mail addresses, secrets after a known prefix or name, account numbers (IBAN), dates, IPv4 addresses,
    payment cards, social security numbers and telephone numbers. Numbers that must pass a rule (Luhn, modulo 97,
    the calendar, number ranges) count only if they do, and their pseudonyms pass it too. A pseudonym is a keyed
    Feistel permutation within its format: of digits and letters in their places, or of the numbers that are valid.
    So the length and signs stay, equal values get equal pseudonyms in all documents, different values different
    ones, and whoever has the key can invert it.

    Null text stays null with no findings; empty text stays empty. A column ``private`` gives way to the new one, all
    others stay; ``n_chars``, where there is one, is counted again. Each row is on its own, whatever its id, repeated
    rows too. No rows give no rows.
    """
    if not key:
        raise ValueError("pseudonyms need a key")
    columns = [c for c in docs.columns if c != "private"]
    # Whatever is found has a digit or an @, or follows one of a few names.
    may = F.coalesce(F.col("text").rlike(r"[0-9@]|(?i:token|secret|passw|api_?key)"), F.lit(False))
    found = F.when(may, F.regexp_extract_all("text", F.lit(PATTERN), F.lit(0))).otherwise(F.array().cast("array<string>"))
    raw, named, new = (free(docs, n) for n in ("found", "named", "new"))
    step = docs.withColumn(raw, found)
    step = step.withColumn(named, F.transform(raw, lambda m: F.struct(m.alias("m"), kind_of(m).alias("kind"))))
    step = step.withColumn(new, F.transform(named, lambda z: F.struct(z["kind"].alias("kind"), pseudonym(key, z["m"], z["kind"]).alias("pseudonym"))))
    gaps = F.split("text", PATTERN, -1)
    filled = F.array_join(F.zip_with(gaps, F.col(new), lambda g, z: F.concat(g, F.coalesce(z["pseudonym"], F.lit("")))), "")
    text = F.when(F.size(new) > 0, filled).otherwise(F.col("text"))
    out = {c: step[c] for c in columns} | {"text": text}
    if "n_chars" in out:
        out["n_chars"] = F.when(F.size(new) > 0, F.length(text).cast("long")).otherwise(F.col("n_chars"))
    return step.select(*[c.alias(n) for n, c in out.items()], F.filter(new, lambda z: z["kind"].isNotNull()).alias("private"))


def key_of(spark: SparkSession) -> str:
    """The key that ``spark.tessera.pseudonym.key`` names; a known one, which hides nothing, where it is unset, as in tests."""
    return spark.conf.get("spark.tessera.pseudonym.key", None) or "a key for tests"


def query(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    out = pseudonymize(docs, key_of(spark))
    return out.select("doc_id", F.size("private").alias("n_private"), F.transform("private", lambda z: z["kind"]).alias("kinds"),
                      F.transform("private", lambda z: z["pseudonym"]).alias("pseudonyms"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("text_sha256"))
