"""Personal data replaced by surrogates, in DataFrame operations only.

Mentions are found by one pattern per kind. A mention's canonical form (digits alone, lower case) is what it refers to: all
mentions of one referent get one surrogate, laid out in each mention's own format. Surrogates come from a keyed hash and keep
the kind's make-up: valid octets, a Luhn digit where there was one, letters for letters, fixed prefixes, names of the same
gender and script. Surrogates of all documents are checked against each other and against all real referents; those that
collide are drawn again until none does, so that different referents stay different.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.llm.common import staged

# Given names by gender, titles, and syllables for made-up names by script.
GIVEN_M = ("John James Robert Michael William David Richard Thomas Charles Daniel Paul Mark George Peter Hans Karl Jürgen Pierre "
           "Jean Luc François José Carlos Juan Miguel Ivan Иван Сергей Дмитрий Алексей Николай").split()
GIVEN_F = ("Mary Patricia Jennifer Linda Elizabeth Susan Jessica Sarah Karen Nancy Lisa Anna Emma Julia Laura Claire Sophie "
           "Marie Camille Ingrid Petra María Carmen Lucía Isabel Ana Анна Мария Елена Ольга Наталья").split()
TITLES = "Mr Mrs Ms Miss Dr Prof Herr Frau Mme Mlle Sr Sra Srta".split()
LATIN = "ba be bo da de do fa fe ka ke ko la le lo ma me mo na ne no ra re ro sa se so ta te to va ve vo".split()
CYRILLIC = "ба бе бо ва ве во да де до ка ке ко ла ле ло ма ме мо на не но ра ре ро са се со та те то".split()

_LETTER = r"\p{L}"
_NAMES = "|".join(GIVEN_M + GIVEN_F)
_TITLES = "|".join(TITLES)
_START, _STOP = r"(?<![0-9A-Za-z])", r"(?![0-9A-Za-z])"
#: Kinds in the order in which they are tried at a place. Each begins with a test of the place that nearly every place fails, and
#: runs of characters are possessive, so that a text is walked through once.
PATTERNS = {
    "email": r"(?<![A-Za-z0-9._%+\-])[A-Za-z0-9._%+\-]{1,64}+@[A-Za-z0-9\-]+(?:\.[A-Za-z0-9\-]+)*\.[A-Za-z]{2,}",
    "key": rf"(?=A[KS]IA){_START}A[KS]IA[0-9A-Z]{{12,20}}{_STOP}|(?=[gspx][hko][opx]?[bap]?[_\-]){_START}(?:ghp|gho|sk|pk|xox[bap])[_\-][0-9A-Za-z\-]{{16,}}+",
    "hex": rf"(?=[0-9a-f]{{32}}){_START}(?=[a-f]*[0-9])(?=[0-9]*[a-f])[0-9a-f]{{32,128}}+{_STOP}"
           rf"|(?=[0-9A-F]{{32}}){_START}(?=[A-F]*[0-9])(?=[0-9]*[A-F])[0-9A-F]{{32,128}}+{_STOP}",
    "iban": rf"(?=[A-Z]{{2}}[0-9]{{2}}){_START}[A-Z]{{2}}[0-9]{{2}}(?: ?[0-9A-Z]{{4}}){{2,7}}(?: ?[0-9A-Z]{{1,3}})?{_STOP}",
    "ip": r"(?=[0-9]{1,3}\.)(?<![0-9.])(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])(?:\.(?:25[0-5]|2[0-4][0-9]|1[0-9]{2}|[1-9]?[0-9])){3}(?![0-9]|\.[0-9])",
    "ssn": r"(?=[0-9]{3}-)(?<![0-9\-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9\-])",
    "card": r"(?=[0-9]{4})(?<![0-9])(?:[0-9]{4}(?:[ \-]?[0-9]{4}){2}[ \-]?[0-9]{1,7}(?![0-9])|3[47][0-9]{2}[ \-]?[0-9]{6}[ \-]?[0-9]{5}(?![0-9]))",
    "phone": r"(?=[+(0-9])(?<![0-9+])(?:(?:\+[0-9]{1,3}[ .\-]?)?(?:\([0-9]{2,4}\)[ .\-]?|[0-9]{2,4}[ .\-])[0-9]{3,4}[ .\-][0-9]{3,4}(?![0-9])|\+[0-9]{8,15}(?![0-9]))",
    "name": rf"(?=\p{{Lu}})(?<!{_LETTER})(?:(?:{_NAMES})(?!{_LETTER})"
            rf"|(?<=(?<!{_LETTER})(?:(?:{_NAMES})(?: \p{{Lu}}{_LETTER}{{1,30}})?|(?:{_TITLES})\.?) )\p{{Lu}}{_LETTER}{{1,30}}+)",
}
#: A capitalised word, which may be a surname told elsewhere in its text.
CAPITALISED = rf"(?<!{_LETTER})\p{{Lu}}{_LETTER}++"
#: After so many draws that met others, a surrogate may take a wider form than its mention's: any octets, longer names and addresses.
NARROW_DRAWS = 6
ANY = "|".join(f"(?:{p})" for p in PATTERNS.values())
DIGITAL = ("ssn", "card", "phone")


def mentions(text: Column) -> Column:
    """All mentions of a text, in order."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(ANY), F.lit(0))


def kind_of(mention: Column) -> Column:
    kind = F.lit("name")
    for name, pattern in reversed([x for x in PATTERNS.items() if x[0] != "name"]):
        kind = F.when(mention.rlike(f"^(?:{pattern})$"), name).otherwise(kind)
    lower = F.lower(mention)
    given = F.when(lower.isin([x.lower() for x in GIVEN_M]), "given_m").when(lower.isin([x.lower() for x in GIVEN_F]), "given_f").otherwise("surname")
    return F.when(kind == "name", given).otherwise(kind)


def canonical(kind: Column, mention: Column) -> Column:
    return (F.when(kind.isin(*DIGITAL), F.regexp_replace(mention, "[^0-9]", "")).when(kind == "iban", F.replace(mention, F.lit(" "), F.lit("")))
            .when(kind.isin("email", "given_m", "given_f", "surname"), F.lower(mention)).otherwise(mention))


def _pick(digest: Column, i: Column, n: int | Column) -> Column:
    """A number below ``n`` from the i-th byte pair of a digest of 128 hex digits."""
    at = F.pmod(i, F.lit(32)) * 4 + 1
    return F.pmod(F.conv(F.substring(digest, at, F.lit(4)), 16, 10).cast("int"), F.lit(n) if isinstance(n, int) else n)


def _luhn_sum(digits: Column) -> Column:
    """Sum of the digits of a reversed array by Luhn's rule, the first one being the check digit."""
    doubled = F.transform(digits, lambda d, i: F.when(i % 2 == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.aggregate(doubled, F.lit(0), lambda a, x: a + x)


def _with_check_digit(text: Column) -> Column:
    """Digits whose last one is set so that Luhn's sum ends in 0."""
    body = F.substring(text, F.lit(1), F.length(text) - 1)
    reverse = F.transform(F.reverse(F.split(F.concat(body, F.lit("0")), "")), lambda c: c.cast("int"))
    return F.concat(body, F.pmod(10 - F.pmod(_luhn_sum(reverse), F.lit(10)), F.lit(10)).cast("string"))


def _passes_luhn(text: Column) -> Column:
    return F.pmod(_luhn_sum(F.transform(F.reverse(F.split(text, "")), lambda c: c.cast("int"))), F.lit(10)) == 0


def draw(kind: Column, real: Column, attempt: Column, key: str) -> Column:
    """A surrogate's canonical form; another one for each attempt."""
    digest = F.sha2(F.concat_ws("\x1f", F.lit(key), kind, real, attempt.cast("string")), 512)
    # More than 32 characters take further digests.
    digests = [F.sha2(F.concat_ws("\x1f", F.lit(key), F.lit(str(k)), kind, real, attempt.cast("string")), 512) for k in range(1, 4)]

    def pick(i, n):
        return F.when(i < 32, _pick(digest, i, n)).when(i < 64, _pick(digests[0], i, n)).when(i < 96, _pick(digests[1], i, n)).otherwise(_pick(digests[2], i, n))

    def letter(i, first: str, n: int):
        return F.char(pick(i, n) + ord(first))

    keep = (F.when(kind == "key", F.when(real.rlike("^A[KS]IA"), 4).otherwise(F.length(F.regexp_extract(real, "^[a-z]+[_-]", 0))))
            .when(kind == "iban", 2).when(kind == "card", 1).when(kind == "phone", F.greatest(F.length(real) - 10, F.lit(0))).otherwise(0))
    top = F.length(real) - F.length(F.regexp_extract(real, r"\.[A-Za-z]{2,}$", 0))  # the end of an address stays

    def swapped(c, i):
        out = (F.when(i < keep, c).when((kind == "email") & (i >= top), c)
               .when(c.rlike("[1-9]"), (pick(i, 9) + 1).cast("string")).when(c == "0", pick(i, 10).cast("string")))
        out = out.when((kind == "hex") & c.rlike("[a-f]"), letter(i, "a", 6)).when((kind == "hex") & c.rlike("[A-F]"), letter(i, "A", 6))
        return out.when(c.rlike("[a-z]"), letter(i, "a", 26)).when(c.rlike("[A-Z]"), letter(i, "A", 26)).otherwise(c)

    plain = F.array_join(F.transform(F.split(real, ""), swapped), "")
    wider = F.greatest(attempt - (NARROW_DRAWS - 1), F.lit(0))  # 0 while the form is the mention's own
    more = F.transform(F.sequence(F.lit(0), wider), lambda i: F.when(i > 0, letter(i + 40, "a", 26)).otherwise(""))
    plain = F.when((kind == "email") & (wider > 0), F.concat(F.array_join(more, ""), plain)).otherwise(plain)
    octets = F.transform(F.split(real, r"\."), lambda o, i: F.when(wider > 0, pick(i, 254) + 1).when(F.length(o) == 1, pick(i, 9) + 1).when(
        F.length(o) == 2, pick(i, 90) + 10).otherwise(pick(i, 156) + 100).cast("string"))
    cyrillic = real.rlike(r"\p{IsCyrillic}")
    count = 2 + F.pmod(attempt, F.lit(3)) + wider
    syllables = F.array_join(F.transform(F.sequence(F.lit(0), count), lambda i: F.when(
        cyrillic, F.element_at(F.array(*map(F.lit, CYRILLIC)), pick(i, len(CYRILLIC)) + 1)).otherwise(
        F.element_at(F.array(*map(F.lit, LATIN)), pick(i, len(LATIN)) + 1))), "")
    ending = (F.when(kind == "given_f", F.when(cyrillic, "на").otherwise("na")).when(kind == "given_m", F.when(cyrillic, "н").otherwise("n"))
              .otherwise(F.when(cyrillic, "ров").otherwise("ler")))
    name = F.concat(syllables, ending)
    card = F.when(_passes_luhn(F.when(kind == "card", real)), _with_check_digit(plain)).otherwise(plain)
    return (F.when(kind == "ip", F.array_join(octets, ".")).when(kind.isin("given_m", "given_f", "surname"), name)
            .when(kind == "card", card).otherwise(plain))


def _as_name(mention: Column, surrogate: Column) -> Column:
    return F.when((F.length(mention) > 1) & (mention == F.upper(mention)), F.upper(surrogate)).when(
        mention == F.lower(mention), surrogate).otherwise(F.initcap(surrogate))


def with_surnames(part: Column, surnames: Column) -> Column:
    """A part of a text between mentions, in which the surnames (lower case -> surrogate) that the text told elsewhere are replaced."""
    words = F.regexp_extract_all(part, F.lit(CAPITALISED), F.lit(0))
    news = F.transform(words, lambda w: F.coalesce(_as_name(w, F.element_at(surnames, F.lower(w))), w))
    mixed = F.zip_with(F.split(part, CAPITALISED, -1), F.concat(news, F.array(F.lit(""))), lambda p, m: F.concat(p, m))
    return F.array_join(mixed, "")


def lay_out(kind: Column, mention: Column, surrogate: Column) -> Column:
    """The surrogate in the format of the mention: separators where they were, capitals as they were."""
    def digit(c, i):
        before = F.length(F.regexp_replace(F.substring(mention, F.lit(1), i), "[^0-9A-Za-z]", ""))
        return F.when(c.rlike("[0-9A-Za-z]"), F.substring(surrogate, before + 1, F.lit(1))).otherwise(c)

    def cased(c, i):
        new = F.substring(surrogate, i + 1, F.lit(1))
        return F.when(c.rlike("[A-Z]"), F.upper(new)).otherwise(new)

    letters = F.split(mention, "")
    named = _as_name(mention, surrogate)
    return (F.when(kind.isin(*DIGITAL, "iban"), F.array_join(F.transform(letters, digit), ""))
            .when(kind == "email", F.concat(F.array_join(F.transform(letters, cased), ""), F.substring(surrogate, F.length(mention) + 1, F.lit(99))))
            .when(kind.isin("given_m", "given_f", "surname"), named).otherwise(surrogate))


class Surrogates:
    """Replaces personal data in ``docs``. The same key and referents give the same surrogates in every run, unless a collision
    was settled otherwise because other referents were present. A surname found after a given name or title is the same person's wherever
    the text has it as a capitalised word; such further places are replaced but not counted. Null texts stay null; rows are known by id and text, so ids may be
    null or repeated; further columns stay as they are."""

    def __init__(self, docs: DataFrame, key: str, id_col: str = "doc_id", text_col: str = "text", most_draws: int = 60):
        self.key, self.text_col, self.most_draws, self.columns = key, text_col, most_draws, docs.columns
        self.docs = docs.select(F.struct("*").alias("row"), F.col(id_col).cast("string").alias("id"), F.xxhash64(text_col).alias("rk"))

    def mentions(self) -> DataFrame:
        """(id, rk, mention, kind, real, n) per document and different mention."""
        found = self.docs.select("id", "rk", F.explode(mentions(F.col("row")[self.text_col])).alias("mention"))
        found = found.groupBy("id", "rk", "mention").agg(F.count("*").alias("n")).withColumn("kind", kind_of(F.col("mention")))
        return staged(found.withColumn("real", canonical(F.col("kind"), F.col("mention"))), "pii-mentions")

    def table(self, found: DataFrame) -> DataFrame:
        """(kind, real, surrogate) of all referents, one surrogate each, none of them real or shared within a kind."""
        drawn = found.select("kind", "real").distinct().withColumn("attempt", F.lit(0))
        drawn = staged(drawn.withColumn("surrogate", draw(F.col("kind"), F.col("real"), F.col("attempt"), self.key)), "pii-drawn")
        reals = staged(drawn.select(F.col("kind").alias("r_kind"), F.col("real").alias("r_real")), "pii-reals")
        for _ in range(self.most_draws):
            order = Window.partitionBy("kind", "surrogate").orderBy("attempt", "real")
            judged = drawn.withColumn("place", F.row_number().over(order)).join(
                reals, (F.col("kind") == F.col("r_kind")) & (F.col("surrogate") == F.col("r_real")), "left")
            judged = staged(judged.select("kind", "real", "attempt", "surrogate", ((F.col("place") > 1) | F.col("r_real").isNotNull()).alias("bad")), "pii-judged")
            if judged.where("bad").isEmpty():
                return judged.select("kind", "real", "surrogate")
            again = judged.where("bad").withColumn("attempt", F.col("attempt") + 1)
            again = again.withColumn("surrogate", draw(F.col("kind"), F.col("real"), F.col("attempt"), self.key))
            drawn = staged(judged.where("not bad").unionByName(again).drop("bad"), "pii-drawn")
        raise RuntimeError(f"surrogates still collide after {self.most_draws} draws: a kind has too few forms for its referents")

    def replaced(self, count_col: str | None = None) -> DataFrame:
        """``docs`` with the text replaced; ``count_col`` adds the number of mentions."""
        found = self.mentions()
        told = found.join(self.table(found), ["kind", "real"])
        told = told.withColumn("new", lay_out(F.col("kind"), F.col("mention"), F.col("surrogate")))
        surname = F.when(F.col("kind") == "surname", F.struct("real", "surrogate"))
        told = told.groupBy("id", "rk").agg(F.map_from_entries(F.collect_list(F.struct("mention", "new"))).alias("new"), F.sum("n").alias("n"),
                                            F.map_from_entries(F.collect_set(surname)).alias("surnames"))
        told = told.select(F.col("id").alias("t_id"), F.col("rk").alias("t_rk"), "new", "n", "surnames")
        rows = self.docs.join(told.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("t_id")) & (F.col("rk") == F.col("t_rk")), "left")
        text = F.col("row")[self.text_col]
        # Between n mentions there are n + 1 other parts.
        parts = F.split(text, ANY, -1)
        parts = F.when(F.size("surnames") > 0, F.transform(parts, lambda p: with_surnames(p, F.col("surnames")))).otherwise(parts)
        news = F.concat(F.transform(mentions(text), lambda m: F.element_at("new", m)), F.array(F.lit("")))
        joined = F.array_join(F.flatten(F.zip_with(parts, news, lambda p, m: F.array(p, m))), "")
        text = F.when(F.col("new").isNull(), text).otherwise(joined)
        out = [text.alias(c) if c == self.text_col else F.col("row")[c].alias(c) for c in self.columns]
        return rows.select(*out, *([F.coalesce("n", F.lit(0)).cast("long").alias(count_col)] if count_col else []))
