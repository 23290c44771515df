"""Double metaphone: two sound codes of a word, by rules read from left to right.

At each place the first rule that fits gives its codes and says how many letters it has used. A rule is a
pattern on the word with a bar before the letter it stands at, so it sees what is before and behind.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The published rules of the method, fixed values: pattern, letters used, first and second code.
# Without looking ahead or back, so that any engine of patterns can read them.
GERMANIC = r"^(?:VAN |VON |SCH).*"


def slavic(rule: str) -> str:
    """A rule for words with W, K or CZ on either side."""
    return rf"(?:W|K|CZ).*{rule}|{rule}.*(?:W|K|CZ)"


RULES = {
    "AEIOUY": [(r"^\|", 1, "A", "A"), (r"\|", 1, "", "")],
    "B": [(r"\|BB", 2, "P", "P"), (r"\|B", 1, "P", "P")],
    "Ç": [(r"\|", 1, "S", "S")],
    "C": [
        (r"[^AEIOUY]A\|CH(?:[^IE]|$)|[BM]A\|CHER", 2, "K", "K"), (r"^\|CAESAR", 2, "S", "S"), (r"\|CHIA", 2, "K", "K"),
        (r".\|CHAE", 2, "K", "X"), (r"^\|CH(?:ARAC|ARIS|OR(?:[^E]|$)|YM|EM)", 2, "K", "K"), (GERMANIC + r"\|CH", 2, "K", "K"),
        (r"OR\|CH(?:ES|ID)|AR\|CHIT|\|CH[TS]|(?:^|[AOUE])\|CH(?:[LRNMBHFVW ]|$)", 2, "K", "K"), (r"^MC.*\|CH", 2, "K", "K"),
        (r".\|CH", 2, "X", "K"), (r"\|CH", 2, "X", "X"), (r"(?:^.?|[^I]|[^W]I)\|CZ", 2, "S", "X"), (r"\|CCIA", 3, "X", "X"),
        (r"^A\|CC[IEH](?:[^U]|$)|U\|CCE[ES]", 3, "KS", "KS"), (r"(?:^|[^M]|.M)\|CC[IEH](?:[^U]|$)", 3, "X", "X"), (r"(?:^|[^M]|.M)\|CC", 2, "K", "K"),
        (r"\|C[KGQ]", 2, "K", "K"), (r"\|CI[OEA]", 2, "S", "X"), (r"\|C[IEY]", 2, "S", "S"), (r"\|C [CQG]", 3, "K", "K"),
        (r"\|CC(?:[^EI]|$)", 2, "K", "K"), (r"\|C", 1, "K", "K"),
    ],
    "D": [(r"\|DG[IEY]", 3, "J", "J"), (r"\|DG", 2, "TK", "TK"), (r"\|D[TD]", 2, "T", "T"), (r"\|D", 1, "T", "T")],
    "F": [(r"\|FF", 2, "F", "F"), (r"\|F", 1, "F", "F")],
    "G": [
        (r"[^AEIOUY]\|GH", 2, "K", "K"), (r"^\|GHI", 2, "J", "J"), (r"^\|GH", 2, "K", "K"), (r"(?:[BHD].|[BHD]..|[BH]...)\|GH", 2, "", ""),
        (r"[CGLRT].U\|GH", 2, "F", "F"), (r"[^I]\|GH", 2, "K", "K"), (r"\|GH", 2, "", ""), (slavic(r"\|GN"), 2, "KN", "KN"),
        (r"^[AEIOUY]\|GN", 2, "KN", "N"), (r"\|GN(?:[^E]|E[^Y]|E?$)", 2, "N", "KN"), (r"\|GN", 2, "KN", "KN"), (slavic(r"\|GLI"), 1, "K", "K"),
        (r"\|GLI", 2, "KL", "L"), (r"^\|G(?:Y|E[SPBLYIR]|I[BLNE])", 2, "K", "J"),
        (r"(?:^|[^EIN]|[^A]N|^N|^AN|[^DRM]AN|.[DRM]AN)\|GER|(?:^|[^EIRO])\|GY", 2, "K", "J"), (GERMANIC + r"\|G[EIY]|\|GET", 2, "K", "K"),
        (r"\|GIER(?: |$)", 2, "J", "J"), (r"\|G[EIY]|[AO]\|GGI", 2, "J", "K"), (r"\|GG", 2, "K", "K"), (r"\|G", 1, "K", "K"),
    ],
    "H": [(r"(?:^|[AEIOUY])\|H[AEIOUY]", 2, "H", "H"), (r"\|H", 1, "", "")],
    "J": [
        (r"^\|JOSE(?: |$)|^SAN \|J", 1, "H", "H"), (r"\|JOSE", 1, "J", "H"), (r"^\|J", 1, "J", "A"), (slavic(r"\|J"), 1, "J", "J"),
        (r"[AEIOUY]\|J[AO]", 1, "J", "H"), (r"\|J$", 1, "J", ""), (r"\|JJ", 2, "J", "J"), (r"(?:^|[^SKL])\|J(?:[^LTKSNMBZ]|$)", 1, "J", "J"),
        (r"\|J", 1, "", ""),
    ],
    "K": [(r"\|KK", 2, "K", "K"), (r"\|K", 1, "K", "K")],
    "L": [(r"I\|LL[OA]$|A\|LLE(?:$|.*[AO]S?$)", 2, "L", ""), (r"\|LL", 2, "L", "L"), (r"\|L", 1, "L", "L")],
    "M": [(r"U\|MB(?:$|ER)", 2, "M", "M"), (r"\|MM", 2, "M", "M"), (r"\|M", 1, "M", "M")],
    "NÑ": [(r"\|NN", 2, "N", "N"), (r"\|", 1, "N", "N")],
    "P": [(r"\|PH", 2, "F", "F"), (r"\|P[PB]", 2, "P", "P"), (r"\|P", 1, "P", "P")],
    "Q": [(r"\|QQ", 2, "K", "K"), (r"\|Q", 1, "K", "K")],
    "R": [(r"(?:W|K|CZ).*\|R(?:[^R]|$)|\|R(?:W|K|CZ|[^R].*(?:W|K|CZ))", 1, "R", "R"),
        (r"(?:^.?|[^EA]|[^M][EA])IE\|R$", 1, "", "R"), (r"\|RR", 2, "R", "R"), (r"\|R", 1, "R", "R")],
    "S": [
        (r"[IY]\|SL", 1, "", ""), (r"^\|SUGAR", 1, "X", "S"), (r"\|SH(?:EIM|OEK|OLM|OLZ)", 2, "S", "S"), (r"\|SH", 2, "X", "X"),
        (slavic(r"\|SI[OA]"), 3, "S", "S"), (r"\|SI[OA]", 3, "S", "X"), (r"^\|S[MNLW]", 1, "S", "X"), (r"\|SZ", 2, "S", "X"),
        (r"\|SCH(?:ER|EN)", 3, "X", "SK"), (r"\|SCH(?:OO|UY|ED|EM)", 3, "SK", "SK"), (r"^\|SCH[^AEIOUYW]", 3, "X", "S"),
        (r"\|SCH", 3, "X", "X"), (r"\|SC[IEY]", 3, "S", "S"), (r"\|SC", 3, "SK", "SK"), (r"[AO]I\|S$", 1, "", "S"),
        (r"\|SS", 2, "S", "S"), (r"\|S", 1, "S", "S"),
    ],
    "T": [
        (r"\|T(?:ION|IA|CH)", 3, "X", "X"), (r"\|TH[OA]M", 2, "T", "T"), (GERMANIC + r"\|TT?H", 2, "T", "T"), (r"\|TT?H", 2, "0", "T"),
        (r"\|T[TD]", 2, "T", "T"), (r"\|T", 1, "T", "T"),
    ],
    "V": [(r"\|VV", 2, "F", "F"), (r"\|V", 1, "F", "F")],
    "W": [
        (r"\|WR", 2, "R", "R"), (r"^\|W[AEIOUY]", 1, "A", "F"), (r"^\|WH", 1, "A", "A"),
        (r"[AEIOUY]\|W$|[EO]\|WSK[IY]|^SCH.*\|W", 1, "", "F"), (r"\|WI[CT]Z", 4, "TS", "FX"), (r"\|W", 1, "", ""),
    ],
    "X": [(r"^\|X", 1, "S", "S"), (r"[AO]U\|X$", 1, "", ""), (r"\|X[CX]", 2, "KS", "KS"), (r"\|X", 1, "KS", "KS")],
    "Z": [
        (r"\|ZH", 2, "J", "J"), (r"\|ZZ[OIA]", 2, "S", "TS"), (r"(?:W|K|CZ)(?:.*[^T])?\|Z|(?:^|[^T])\|Z.*(?:W|K|CZ)", 1, "S", "TS"), (r"\|ZZ", 2, "S", "S"),
        (r"\|Z", 1, "S", "S"),
    ],
}
# Beginnings whose first letter is silent.
SILENT = r"^(?:GN|KN|PN|WR|PS)"
LENGTH = 4
# Letters and their capitals; others have no sound.
LETTERS = "abcdefghijklmnopqrstuvwxyzçñ", "ABCDEFGHIJKLMNOPQRSTUVWXYZÇÑ"


def rule_of(letter: Column, marked: Column) -> Column:
    """(used, one, two) of the first rule that fits; other characters have no sound."""
    out = None
    for letters, rules in RULES.items():
        own = None
        for pattern, used, one, two in rules:
            codes = F.struct(F.lit(used).alias("used"), F.lit(one).alias("one"), F.lit(two).alias("two"))
            own = F.when(marked.rlike(pattern), codes) if own is None else own.when(marked.rlike(pattern), codes)
        here = letter.isin(*letters)
        out = F.when(here, own) if out is None else out.when(here, own)
    return out.otherwise(F.struct(F.lit(1).alias("used"), F.lit("").alias("one"), F.lit("").alias("two")))


def bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), 0)


def double_metaphone(word: Column, length: int = LENGTH) -> Column:
    """(one, two): the codes of a word, cut to ``length`` letters; equal where the rules know one only.

    A NULL word has NULL codes; one without a sounding letter has empty ones and is not read at all. Reading costs
    some patterns per letter, so code distinct words, not every place they stand at.
    """
    text = F.translate(word, LETTERS[0], LETTERS[1])
    silent = F.struct(F.lit("").alias("one"), F.lit("").alias("two"))
    return F.when(word.isNull(), None).when(~text.rlike(f"[{LETTERS[1]}]"), silent).otherwise(bound(text, lambda t: read_codes(t, length)))


def read_codes(text: Column, length: int) -> Column:
    def step(state: Column, place: Column) -> Column:
        marked = F.concat(F.substr(text, F.lit(1), place), F.lit("|"), F.substr(text, place + 1))
        here = F.struct(F.substr(text, place + 1, F.lit(1)).alias("letter"), marked.alias("marked"))

        def added(found: Column) -> Column:
            return F.struct(
                (place + found["used"]).alias("next"), F.concat(state["one"], found["one"]).alias("one"),
                F.concat(state["two"], found["two"]).alias("two"),
            )

        read = bound(bound(here, lambda h: rule_of(h["letter"], h["marked"])), added)
        return F.when(place < state["next"], state).otherwise(read)

    first = F.when(text.rlike(SILENT), 1).otherwise(0)
    start = F.struct(first.alias("next"), F.lit("").alias("one"), F.lit("").alias("two"))
    places = F.when(F.length(text) > 0, F.sequence(F.lit(0), F.length(text) - 1)).otherwise(F.array().cast("array<int>"))
    return F.aggregate(places, start, step, lambda s: F.struct(
        F.substring(s["one"], 1, length).alias("one"), F.substring(s["two"], 1, length).alias("two")))


def double_postings(postings: DataFrame, length: int = LENGTH) -> DataFrame:
    """A term table with two tokens per place where a word has two codes: the field, a code, and the rest.

    Codes are worked out once per distinct term and joined; a very common term is split by the skew join. A word
    without a sounding letter is its own token, as numbers are. Each term has a token, so ``explode_outer`` gives
    the rows of ``explode``; of ``explode``, Spark infers a filter on the codes and works it out below the distinct.
    """
    terms = postings.select("term").distinct()
    codes = terms.withColumn("_codes", double_metaphone(F.col("term"), length))
    tokens = F.array_distinct(F.filter(F.array("_codes.one", "_codes.two"), lambda c: c != ""))
    named = codes.select("term", F.when(F.size(tokens) > 0, tokens).otherwise(F.array("term")).alias("_tokens"))
    rest = [c for c in postings.columns if c != "token"]
    return postings.join(named, "term").withColumn("token", F.explode_outer("_tokens")).select("token", *rest)
