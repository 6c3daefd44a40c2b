"""Personal data replaced by format-preserving Feistel pseudonyms, in DataFrame functions only.

One regular expression finds every place of the whole text where a candidate starts; each is validated (Luhn sum, octets,
calendar, area numbers, IBAN sum; cards and IBANs at each of their possible ends, longest first), and from left to right
the valid ones that start behind the last one's end are permuted inside their own format by eight keyed Feistel
rounds (round function: SHA-256 of key, kind, round and the other half).  An invalid candidate hides nothing.
A permutation never merges two values, and equal values get equal pseudonyms in every document, however cards,
IBANs and phones are spaced.

* emails: letters and digits of the local part; the domain and all punctuation stay
* phones: the digits after the country code
* cards (13 to 19 digits, Luhn): all digits but the last, which becomes the new check digit; spaces and hyphens stay
* IPv4: the two pairs of octets, each a number below 65536
* dates (yyyy-MM-dd, dd.MM.yyyy, MM/dd/yyyy; years 1800 to 2199): the day of the 400-year cycle, 189 x 773 days
* social security numbers: area and group (898 x 99) against the serial (9999)
* IBANs: letters and digits after the check digits, which are computed anew
* secrets (cloud access key ids, values of password and token assignments, names in any case): letters within letters,
  digits within digits; a value that is a valid one of another kind as a whole is of that kind

Defined cases: null stays null (nothing found), empty stays empty, invalid candidates and all other text stay as they
are; repeated rows change alike; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm.common import table

KEY = "change-me"
ROUNDS = 8
#: kind -> pattern (Java)
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}@[A-Za-z0-9-]{1,63}(?:\.[A-Za-z0-9-]{1,63}){1,8}",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?:[ ]?[A-Z0-9]{4}){2,7}(?:[ ]?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "access_key": r"(?<![A-Za-z0-9])A[KS]IA[A-Z0-9]{16}(?![A-Za-z0-9])",
    "secret": r"(?<=[=:][ \"']{0,3})(?<=(?i:password|passwd|pwd|token|secret|api_key|apikey)[ ]{0,2}[=:][ ]{0,2}[\"']?)[A-Za-z0-9_+/.-]{8,}",
    "date": r"(?<![0-9/.-])(?:[0-9]{4}-[0-9]{2}-[0-9]{2}|[0-9]{2}\.[0-9]{2}\.[0-9]{4}|[0-9]{2}/[0-9]{2}/[0-9]{4})(?![0-9])",
    "ssn": r"(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-])",
    "ip": r"(?<![0-9.])[0-9]{1,3}(?:\.[0-9]{1,3}){3}(?!\.?[0-9])",
    "phone": r"(?<![0-9+])(?:\+[0-9]{1,3}[ .-]?)?(?:\([0-9]{3}\)[ ]?|[0-9]{3}[.-])[0-9]{3}[.-][0-9]{4}(?![0-9])",
    "card": r"(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9])",
}
#: kinds that cannot both match at one place, but for emails, which are always valid
_PLAIN = "|".join(p for k, p in PATTERNS.items() if k not in ("secret", "card"))
#: the empty string before a candidate; groups: the secret, the plain kind and the longest card that start there
CANDIDATE = f"(?=({PATTERNS['secret']})|{_PLAIN}|{PATTERNS['card']})(?=({_PLAIN})?)(?=({PATTERNS['card']})?)"


def _let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.transform(F.array(value), body)[0]


def _code(digest: Column, start: Column, digits: int) -> Column:
    return F.conv(F.substr(digest, start, F.lit(digits)), 16, 10).cast("long")


def _shifted(half: Column, other: Column, tag: Column) -> Column:
    """Each letter and digit of ``half`` moved inside its class by key bytes drawn from ``other``."""
    def one(i: Column) -> Column:
        c = F.ascii(F.substr(half, i, F.lit(1)))
        block = F.floor((i - 1) / 16).cast("string")
        k = _code(F.sha2(F.concat_ws("|", tag, block, other).cast("binary"), 256), ((i - 1) % 16) * 4 + 1, 4)

        def move(first: int, size: int) -> Column:
            return F.char(F.lit(first) + (c - first + k) % size)

        return (F.when(c.between(48, 57), move(48, 10)).when(c.between(97, 122), move(97, 26))
                .when(c.between(65, 90), move(65, 26)).otherwise(F.substr(half, i, F.lit(1))))

    return F.when(F.length(half) == 0, F.lit("")).otherwise(
        F.array_join(F.transform(F.sequence(F.lit(1), F.length(half)), one), ""))


def permute_text(value: Column, kind: str, key: str) -> Column:
    """Feistel rounds over the two halves of a string; letters stay letters, digits digits, the rest as it is."""
    middle = F.floor(F.length(value) / 2).cast("int")
    start = F.struct(F.substr(value, F.lit(1), middle).alias("l"), F.substr(value, middle + 1, F.length(value)).alias("r"))
    done = F.aggregate(F.sequence(F.lit(1), F.lit(ROUNDS)), start, lambda a, i: F.struct(
        a["r"].alias("l"), _shifted(a["l"], a["r"], F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"))).alias("r")))
    return _let(done, lambda d: F.concat(d["l"], d["r"]))


def permute_pair(x: Column, y: Column, size_x: int, size_y: int, kind: str, key: str) -> Column:
    """Feistel rounds over a pair of numbers below ``size_x`` and ``size_y``: struct of (x, y)."""
    def step(a: Column, i: Column) -> Column:
        other = F.when(i % 2 == 0, a["y"]).otherwise(a["x"])
        tag = F.concat_ws("|", F.lit(key), F.lit(kind), i.cast("string"), other.cast("string"))
        k = _code(F.sha2(tag.cast("binary"), 256), F.lit(1), 12)
        return F.struct(F.when(i % 2 == 0, (a["x"] + k) % size_x).otherwise(a["x"]).alias("x"),
                        F.when(i % 2 == 1, (a["y"] + k) % size_y).otherwise(a["y"]).alias("y"))

    start = F.struct(x.cast("long").alias("x"), y.cast("long").alias("y"))
    return F.aggregate(F.sequence(F.lit(0), F.lit(ROUNDS - 1)), start, step)


def _digits(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def _placed(value: Column, new: Column) -> Column:
    """``value`` with its letters and digits replaced by those of ``new``, in order; all else stays."""
    def at(i: Column) -> Column:
        c = F.substr(value, i, F.lit(1))
        place = F.length(F.regexp_replace(F.substr(value, F.lit(1), i), "[^A-Za-z0-9]", ""))
        return F.when(c.rlike("[A-Za-z0-9]"), F.substr(new, place, F.lit(1))).otherwise(c)

    return F.array_join(F.transform(F.sequence(F.lit(1), F.length(value)), at), "")


def _luhn_sum(digits: Column, doubled_last: bool) -> Column:
    """Luhn sum; ``doubled_last``: the last digit is doubled (a payload without its check digit)."""
    n = F.length(digits)

    def add(total: Column, i: Column) -> Column:
        d = F.substr(digits, i, F.lit(1)).cast("int")
        twice = (n - i) % 2 == (0 if doubled_last else 1)
        return total + F.when(twice, 2 * d - F.when(d > 4, 9).otherwise(0)).otherwise(d)

    return F.aggregate(F.sequence(F.lit(1), n), F.lit(0), add)


def _card(value: Column, key: str) -> Column:
    digits = _digits(value)
    payload = permute_text(F.substr(digits, F.lit(1), F.length(digits) - 1), "card", key)
    return _let(_let(payload, lambda x: F.concat(x, ((10 - _luhn_sum(x, True) % 10) % 10).cast("string"))),
                lambda new: _placed(value, new))


def _octet(value: Column, i: int) -> Column:
    return F.split_part(value, F.lit("."), F.lit(i)).cast("int")


def _ip(value: Column, key: str) -> Column:
    new = permute_pair(_octet(value, 1) * 256 + _octet(value, 2), _octet(value, 3) * 256 + _octet(value, 4),
                       65536, 65536, "ip", key)
    return _let(new, lambda p: F.concat_ws(".", *[part.cast("string") for n in (p["x"], p["y"])
                                                  for part in (F.floor(n / 256), n % 256)]))


def _as_date(value: Column) -> Column:
    iso, dotted = value.rlike("^[0-9]{4}-"), value.rlike(r"\.")
    y = F.when(iso, F.substr(value, F.lit(1), F.lit(4))).otherwise(F.substr(value, F.lit(7), F.lit(4)))
    m = F.when(iso, F.substr(value, F.lit(6), F.lit(2))).when(dotted, F.substr(value, F.lit(4), F.lit(2))).otherwise(
        F.substr(value, F.lit(1), F.lit(2)))
    d = F.when(iso, F.substr(value, F.lit(9), F.lit(2))).when(dotted, F.substr(value, F.lit(1), F.lit(2))).otherwise(
        F.substr(value, F.lit(4), F.lit(2)))
    return F.concat_ws("-", y, m, d).try_cast("date")


def _date(value: Column, key: str) -> Column:
    day = F.datediff(_as_date(value), F.lit("1800-01-01").cast("date"))
    new = _let(permute_pair(F.floor(day / 773), day % 773, 189, 773, "date", key), lambda p: F.date_add(
        F.lit("1800-01-01").cast("date"), (p["x"] * 773 + p["y"]).cast("int")).cast("string"))

    def written(new: Column) -> Column:
        y, m, d = (F.split_part(new, F.lit("-"), F.lit(i)) for i in (1, 2, 3))
        return (F.when(value.rlike("^[0-9]{4}-"), new).when(value.rlike(r"\."), F.concat_ws(".", d, m, y))
                .otherwise(F.concat_ws("/", m, d, y)))

    return _let(new, written)


def _ssn(value: Column, key: str) -> Column:
    area, group, serial = (F.split_part(value, F.lit("-"), F.lit(i)).cast("int") for i in (1, 2, 3))
    rank = F.when(area < 666, area - 1).otherwise(area - 2)  # 001 to 899 without 666

    def written(p: Column) -> Column:
        new = F.floor(p["x"] / 99).cast("int")
        return F.concat_ws("-", F.lpad(F.when(new < 665, new + 1).otherwise(new + 2).cast("string"), 3, "0"),
                           F.lpad((p["x"] % 99 + 1).cast("string"), 2, "0"), F.lpad((p["y"] + 1).cast("string"), 4, "0"))

    return _let(permute_pair(rank * 99 + group - 1, serial - 1, 898 * 99, 9999, "ssn", key), written)


def _mod97(value: Column) -> Column:
    """Remainder of letters and digits (A = 10, ...) read as one number."""
    def add(total: Column, i: Column) -> Column:
        c = F.ascii(F.substr(value, i, F.lit(1)))
        return F.when(c < 58, (total * 10 + c - 48) % 97).otherwise((total * 100 + c - 55) % 97)

    return F.aggregate(F.sequence(F.lit(1), F.length(value)), F.lit(0), add)


def _iban_rest(value: Column) -> Column:
    return F.regexp_replace(F.substr(value, F.lit(5), F.length(value)), " ", "")


def _iban(value: Column, key: str) -> Column:
    land = F.substr(value, F.lit(1), F.lit(2))

    def written(rest: Column) -> Column:
        check = 98 - _mod97(F.concat(rest, land, F.lit("00")))
        return F.concat(land, F.lpad(check.cast("string"), 2, "0"), rest)

    return _let(_let(permute_text(_iban_rest(value), "iban", key), written), lambda new: _placed(value, new))


def _phone(value: Column, key: str) -> Column:
    head = F.regexp_extract(value, r"^(?:\+[0-9]{1,3}[ .-]?)?", 0)
    rest = F.substr(value, F.length(head) + 1, F.length(value))
    return F.concat(head, _let(permute_text(_digits(rest), "phone", key), lambda new: _placed(rest, new)))


def _email(value: Column, key: str) -> Column:
    local = F.substring_index(value, "@", 1)
    return F.concat(permute_text(local, "email", key), F.substr(value, F.length(local) + 1, F.length(value)))


def _valid(kind: str, value: Column) -> Column:
    """The longest valid beginning of a card or an IBAN that ends where a run of letters and digits does, null if none."""
    ok = {"iban": lambda v: _mod97(F.concat(_iban_rest(v), F.substr(v, F.lit(1), F.lit(4)))) == 1,
          "card": lambda v: _luhn_sum(_digits(v), False) % 10 == 0}[kind]
    ends = F.filter(F.sequence(F.length(value), F.lit(1), F.lit(-1)),
                    lambda i: F.substr(value, i, F.lit(2)).rlike("^[A-Za-z0-9]([^A-Za-z0-9]|$)"))
    whole = f"^(?:{PATTERNS[kind]})$"
    return F.get(F.filter(F.transform(ends, lambda i: F.substr(value, F.lit(1), i)), lambda v: v.rlike(whole) & ok(v)), 0)


def kind_of(value: Column) -> Column:
    """Kind of a plain candidate that is no IBAN, null if it is not valid."""
    valid = {
        "date": F.year(_as_date(value)).between(1800, 2199),
        "ssn": ~value.rlike("^(000|666|9)|-00-|-0000$"),
        "ip": (_octet(value, 1) < 256) & (_octet(value, 2) < 256) & (_octet(value, 3) < 256) & (_octet(value, 4) < 256),
    }
    out = F.when(value.contains("@"), F.lit("email"))
    for kind in ("access_key", "date", "ssn", "ip", "phone"):
        out = out.when(value.rlike(f"^(?:{PATTERNS[kind]})$"), F.when(valid[kind], F.lit(kind)) if kind in valid else F.lit(kind))
    return out


def _best(secret: Column, plain: Column, card: Column) -> Column:
    """Struct of kind and value of what starts at one place (empty: no such candidate), null if nothing is valid."""
    def of(kind: Column, value: Column) -> Column:
        return F.when(kind.isNotNull() & value.isNotNull(), F.struct(kind.alias("kind"), value.alias("value")))

    iban = ~plain.contains("@") & plain.rlike("^[A-Z]{2}[0-9]{2}")
    other = F.coalesce(F.when(iban, _let(_valid("iban", plain), lambda v: of(F.lit("iban"), v)))
                       .when(plain != "", _let(kind_of(plain), lambda k: of(k, plain))),
                       F.when(card != "", _let(_valid("card", card), lambda v: of(F.lit("card"), v))))
    return _let(other, lambda x: F.when((secret != "") & (F.coalesce(F.length(x["value"]), F.lit(0)) < F.length(secret)),
                                        of(F.lit("secret"), secret)).otherwise(x))


def _after(best: Column, skip: Column) -> Column:
    """Characters from a place on that do not stay: the rest of an earlier value, or the value that starts here."""
    return F.when(skip > 0, skip).otherwise(F.coalesce(F.length(best["value"]), F.lit(0)))


def pseudonym(value: Column, kind: Column, key: str = KEY) -> Column:
    return (F.when(kind == "email", _email(value, key)).when(kind == "iban", _iban(value, key))
            .when(kind == "access_key", F.concat(F.substr(value, F.lit(1), F.lit(4)),
                                                 permute_text(F.substr(value, F.lit(5), F.length(value)), "access_key", key)))
            .when(kind == "secret", permute_text(value, "secret", key)).when(kind == "date", _date(value, key))
            .when(kind == "ssn", _ssn(value, key)).when(kind == "ip", _ip(value, key))
            .when(kind == "phone", _phone(value, key)).when(kind == "card", _card(value, key)).otherwise(value))


def pseudonymised(docs: DataFrame, text: str = "text", key: str = KEY) -> DataFrame:
    """``(row, new_text, found)``: the input row as a struct, its rewritten text and its valid values in order, each a
    struct of (kind, value, pseudonym)."""
    hold = docs.select(F.struct(*[docs[c] for c in docs.columns]).alias("row"), docs[text].alias("t"))
    # every candidate holds a digit, an @ or stands behind an assignment
    hold = hold.withColumn("has", F.coalesce(F.col("t").rlike("[0-9@=:]"), F.lit(False)))
    # a line feed first, so that no candidate starts the text: a piece before the first place, then one from each on
    hold = hold.withColumns({f"c{g}": F.when(F.col("has"), F.regexp_extract_all(F.concat(F.lit("\n"), F.col("t")), F.lit(CANDIDATE), F.lit(g)))
                             .otherwise(F.array().cast("array<string>")) for g in (1, 2, 3)})
    hold = hold.withColumn("best", F.transform(F.arrays_zip("c1", "c2", "c3"), lambda x: _best(x["c1"], x["c2"], x["c3"])))
    hold = hold.withColumn("pieces", F.when(F.size("best") > 0, F.split(F.concat(F.lit("\n"), F.col("t")), CANDIDATE, -1)))
    hold = hold.select("row", "t", F.col("pieces")[0].alias("head"), F.transform("best", lambda b, i: F.struct(
        b.alias("best"), F.get("pieces", i + 1).alias("piece"))).alias("places"))
    # what is left of an earlier value at each place: only a value longer than its piece reaches the next place
    start = F.struct(F.lit(0).alias("skip"), F.array().cast("array<int>").alias("out"))
    skips = F.aggregate("places", start, lambda a, x: F.struct(
        F.greatest(_after(x["best"], a["skip"]) - F.length(x["piece"]), F.lit(0)).alias("skip"),
        F.concat(a["out"], F.array(a["skip"])).alias("out")))["out"]
    reaches = F.exists("places", lambda x: F.length(x["best"]["value"]) > F.length(x["piece"]))
    hold = hold.withColumn("skips", F.when(F.coalesce(reaches, F.lit(False)), skips))
    hold = hold.withColumn("places", F.transform("places", lambda x, i: _let(F.coalesce(F.get("skips", i), F.lit(0)), lambda k: F.struct(
        F.when(k == 0, x["best"]).alias("best"), F.substr(x["piece"], _after(x["best"], k) + 1, F.length(x["piece"])).alias("rest")))))
    hold = hold.withColumn("places", F.transform("places", lambda x: F.struct(
        x["best"]["kind"].alias("kind"), x["best"]["value"].alias("value"),
        F.when(x["best"].isNotNull(), pseudonym(x["best"]["value"], x["best"]["kind"], key)).alias("pseudonym"), x["rest"].alias("rest"))))
    new = F.concat(F.substr("head", F.lit(2), F.length("head")), F.array_join(F.transform(
        "places", lambda x: F.concat(F.coalesce(x["pseudonym"], F.lit("")), x["rest"])), ""))
    hold = hold.withColumn("found", F.transform(F.filter("places", lambda x: x["kind"].isNotNull()), lambda x: F.struct(
        x["kind"].alias("kind"), x["value"].alias("value"), x["pseudonym"].alias("pseudonym"))))
    return hold.select("row", F.when(F.size("found") > 0, new).otherwise(F.col("t")).alias("new_text"), "found")


def op10_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document: doc_id, rewritten text, n_found, kinds (distinct, sorted, comma-joined), pseudonyms in order."""
    out = pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("row.doc_id", F.col("new_text").alias("text"), F.size("found").cast("long").alias("n_found"),
                      F.array_join(F.array_sort(F.array_distinct(F.transform("found", lambda x: x["kind"]))), ",")
                      .alias("kinds"), F.array_join(F.transform("found", lambda x: x["pseudonym"]), "\n").alias("pseudonyms"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline: every text rewritten; all other columns as they were."""
    return pseudonymised(docs).select(*[F.col("new_text").alias("text") if c == "text" else F.col("row").getField(c).alias(c)
                                        for c in docs.columns])
