"""Stop words and the word test, as native column expressions.

A word is rejected when it is shorter than two UTF-16 units, when it holds an ASCII
digit, or when the stop list covers it.  "Covers" has two modes:

``substring``
    the word occurs anywhere inside the newline-joined list text, so ``ring`` is covered
    by ``during`` (this is the behaviour the published counts rest on);
``exact``
    the word is an entry of the list.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import lru_cache, reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------------------
# The stop words.  Results only agree with published counts when the list
# holds exactly these entries, so they are data, not a matter of taste.
# ---------------------------------------------------------------------------------------
ENGLISH = """
a about above across after afterwards again against all almost alone along already also although
always am among amongst amoungst amount an and another any anyhow anyone anything anyway anywhere
are around as at back be became because become becomes becoming been before beforehand behind
being below beside besides between beyond bill both bottom but by call can cannot cant co computer
con could couldnt cry de describe detail do done down due during each eg eight either eleven else
elsewhere empty enough etc even ever every everyone everything everywhere except few fifteen fify
fill find fire first five for former formerly forty found four from front full further get give go
had has hasnt have he hence her here hereafter hereby herein hereupon hers herself him himself his
how however hundred i ie if in inc indeed interest into is it its itself keep last latter latterly
least less ltd made many may me meanwhile might mill mine more moreover most mostly move much must
my myself name namely neither never nevertheless next nine no nobody none noone nor not nothing
now nowhere of off often on once one only onto or other others otherwise our ours ourselves out
over own part per perhaps please put rather re same see seem seemed seeming seems serious several
she should show side since sincere six sixty so some somehow someone something sometime sometimes
somewhere still such system take ten than that the their them themselves then thence there
thereafter thereby therefore therein thereupon these they thick thin third this those though three
through throughout thru thus to together too top toward towards twelve twenty two un under until
up upon us very via was we well were what whatever when whence whenever where whereafter whereas
whereby wherein whereupon wherever whether which while whither who whoever whole whom whose why
will with within without would yet you your yours yourself yourselves
""".split()

HEBREW = """
״ ׳ של רב פי עם עליו עליהם על עד מן מכל מי מהם מה מ למה לכל לי לו להיות לה לא כן כמה כלי כל כי
יש ימים יותר יד י זה ז ועל ומי ולא וכן וכל והיא והוא ואם ו הרבה הנה היו היה היא הזה הוא דבר ד ג
בני בכל בו בה בא את אשר אם אלה אל אך איש אין אחת אחר אחד אז אותו ? ^ ? ; : 1 . - * " ! שלשה בעל
פני ) גדול שם עלי עולם מקום לעולם לנו להם ישראל יודע זאת השמים הזאת הדברים הדבר הבית האמת דברי
במקום בהם אמרו אינם אחרי אותם אדם ( חלק שני שכל שאר ש ר פעמים נעשה ן ממנו מלא מזה ם לפי ל כמו
כבר כ זו ומה ולכל ובין ואין הן היתה הא ה בל בין בזה ב אף אי אותה או אבל א
""".split()

SYMBOLS = """
[ ] - / < • ■ # $ % — ־ £
""".split()
# ------------------------------------------------------------------ end of fixed values

STOP_WORD_MODES = ("substring", "exact")


def default_stop_words() -> list[str]:
    """English, Hebrew and symbol entries; all apply whatever the corpus language is."""
    return ENGLISH + HEBREW + SYMBOLS


def stop_text(stop_words: Sequence[str] | None = None) -> str:
    return "\n".join(default_stop_words() if stop_words is None else stop_words)


@lru_cache(maxsize=1)
def _default_fragments() -> tuple[str, ...]:
    """Every substring of every default entry: what substring mode covers, as a finite set."""
    return tuple(sorted({
        w[i:j]
        for w in ("", *default_stop_words())
        for i in range(len(w) + 1) for j in range(i, len(w) + 1)
    }))


def _is_one_of(word: str, values: Sequence[str]) -> Column:
    """Hash-set membership.  One parsed IN list instead of a Python call per literal."""
    plain = [v for v in values if "'" not in v and "\\" not in v]
    special = [v for v in values if "'" in v or "\\" in v]
    test = F.lit(False)
    if plain:
        test = F.expr(f"`{word}` IN ('" + "','".join(plain) + "')")
    if special:
        test = test | F.col(word).isin(*special)
    return test


def is_short(word: str) -> Column:
    """Fewer than two UTF-16 units.  A four-byte UTF-8 character counts as two."""
    return (F.length(word) < 2) & (F.octet_length(word) < 4)


def has_digit(word: str) -> Column:
    return F.col(word).rlike("[0-9]")


def _words_of(stop_words: Sequence[str] | None, mode: str) -> tuple[str, ...]:
    if mode not in STOP_WORD_MODES:
        raise ValueError(f"stopword_mode must be one of {STOP_WORD_MODES}, not {mode!r}")
    return tuple(default_stop_words() if stop_words is None else stop_words)


FRAGMENTS_IN_PLAN = 200_000  # substrings of an own list held as a hash set in the plan


def _fragments(words: tuple[str, ...]) -> tuple[str, ...] | None:
    """Every substring of every entry, or None where there are more than FRAGMENTS_IN_PLAN."""
    if words == tuple(default_stop_words()):
        return _default_fragments()
    if sum(len(w) * (len(w) + 1) // 2 for w in set(words)) > FRAGMENTS_IN_PLAN:
        return None
    return tuple(sorted({"", *(w[i:j] for w in words for i in range(len(w)) for j in range(i + 1, len(w) + 1))}))


def needs_join(stop_words: Sequence[str] | None, mode: str) -> bool:
    """True where substring mode covers too many fragments for a set in the plan: the words
    are then tested by an anti join with a fragment table (``without_listed_words``)."""
    return mode == "substring" and _fragments(_words_of(stop_words, mode)) is None


def _is_covered(word: str, words: tuple[str, ...], mode: str) -> Column:
    """Decides every word without a newline.

    Searching the list text for each word costs about 1 microsecond per word, which would be
    the most expensive thing the counting scan does.  A word without a newline lies inside
    the joined text exactly when it lies inside one entry, so substring mode is a lookup in
    the set of all entry substrings, for the default list and for own lists of up to
    ``FRAGMENTS_IN_PLAN`` substrings.  Larger lists are joined as a table by the counting
    operators (``needs_join``); only this column form searches their text, as one literal.
    """
    if mode == "exact":
        return _is_one_of(word, sorted(set(words)))
    fragments = _fragments(words)
    if fragments is not None:
        return _is_one_of(word, fragments)
    return F.contains(F.lit(stop_text(words)), F.col(word))


def _spans_entries(word: str, words: tuple[str, ...]) -> Column:
    """A word with a newline can match across entries; only these search the list text."""
    return F.contains(word, F.lit("\n")) & F.contains(F.lit(stop_text(words)), F.col(word))


def is_listed(
    word: str, stop_words: Sequence[str] | None = None, mode: str = "substring"
) -> Column:
    """True when the stop list covers the word."""
    words = _words_of(stop_words, mode)
    covered = _is_covered(word, words, mode)
    return covered if mode == "exact" else covered | _spans_entries(word, words)


def bigram_rejections(
    texts: Sequence[str], stop_words: Sequence[str] | None = None, mode: str = "substring"
) -> list[Column]:
    """``is_stop_word(w1) | is_stop_word(w2)`` as a list of tests, cheapest first.

    For a list that ``needs_join``, the entry test is left to that join.

    ``texts`` are the columns to search for digits and newlines: either the words, or the
    n-gram they came from, which needs one search instead of two.
    """
    words = _words_of(stop_words, mode)

    def some(test: Callable[[str], Column], columns: Sequence[str]) -> Column:
        return reduce(or_, map(test, columns))

    sides = ("w1", "w2")
    late = some(has_digit, texts)
    if mode == "substring":
        unusual = F.concat(*texts).rlike("[0-9\n]")  # one search for both words
        late = unusual & (late | some(lambda w: _spans_entries(w, words), sides))
    covered = [] if needs_join(stop_words, mode) else [_is_covered(w, words, mode) for w in sides]
    return [some(is_short, sides), *covered, late]


def is_stop_word(
    word: str, stop_words: Sequence[str] | None = None, mode: str = "substring"
) -> Column:
    """The whole word test for the column named ``word``."""
    return is_short(word) | is_listed(word, stop_words, mode) | has_digit(word)


def without_listed_words(
    bigrams: DataFrame, stop_words: DataFrame, mode: str = "exact"
) -> DataFrame:
    """Bigrams without a word that a stop-word table (column ``word``) of any size covers.

    ``substring`` mode lists every substring of every entry, in Spark, and joins that.  No
    broadcast hint: Spark broadcasts the table when its measured size allows it and falls
    back to a shuffled anti join otherwise.  The extra exchange of the table lets adaptive
    execution split a join partition that one word dominates.
    """
    if mode not in STOP_WORD_MODES:
        raise ValueError(f"mode must be one of {STOP_WORD_MODES}, not {mode!r}")
    listed = stop_words.select("word").where("word is not null")
    if mode == "substring":
        starts = F.explode(F.sequence(F.lit(1), F.greatest(F.length("word"), F.lit(1))))
        rest = listed.distinct().select("word", starts.alias("start"))
        sizes = F.sequence(F.lit(0), F.greatest(F.length("word") - F.col("start") + 1, F.lit(0)))
        listed = rest.select("word", "start", F.explode(sizes).alias("size")).select(
            F.substring("word", F.col("start"), F.col("size")).alias("word")
        )
    listed = listed.distinct().repartition(F.xxhash64("word"))
    for side in ("w1", "w2"):
        bigrams = bigrams.join(listed.withColumnRenamed("word", side), side, "left_anti")
    return bigrams
