"""Statistics that tell natural prose from lists, tables and junk."""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from corpusloom.functions import quality
from corpusloom.functions.text import text_lines

#: Finite verbs that an English sentence is told by, and its commonest words.
_VERBS = "shall may must should will would can could might is are was were has have had do does did be been being costs".split()
COMMON_EN = "the a an of to and in for on by with at as that or be is are shall may it this from not any no which where if than".split()
COMMON_KO = "및 또는 등 그 이 수 있다 한다 된다 본다 경우 경우에는 때에는 대한 관한 따라 위하여 다음 각 제 이상 이하 다만 것으로 하여야 아니 없다 정한다".split()
_VERB = re.compile(r"\b(?:" + "|".join(_VERBS) + r")\b")
_COMMON = re.compile(r"\b(?:" + "|".join(COMMON_EN) + r")\b", re.I)
#: What parts a line into cells, and what a new item, heading or note begins with.
_CELLS = re.compile(r"\t+|\|+| {2,}|　+")
_TAG = re.compile(r"</?[A-Za-z!][^<>\n]*>|&lt;.*?&gt;|&[a-z]+;|&#\d+;")
_NEW = re.compile(r"\s*(?:[•○●□■◦▪※☐\-*#=<\[{|!$\\:`~]|[①-⓿㉠-㉿]|\(?[0-9A-Za-z가-힣]{1,3}[.)]|제\d+조|Article \d|Annex|\d+\s*$)")
#: Where a sentence ends: after a Korean predicate, or a point that a capital, sign or nothing follows.
_END = re.compile(r"(?:(?<=[가-힣]다)(?<![마보]다)\.?|(?<=[^\s.])[.!?])(?=\s|$|[<(\[”\"’')*_~&'\\])")
_KOREAN = re.compile(r"(?<![마보])[다][\s.!?”’\"')*_~\]]*$")
_UNREADABLE = re.compile(r"[^0-9A-Za-z가-힣\s!-~·“”‘’…–—①-⓿○●•℃㎏㎥㎡ㆍ±×÷≤≥§°]")
_HANGUL = re.compile("[가-힣]+")
#: Without one of these, no piece of a text is a sentence.
POSSIBLE = "다(?![가-힣])|(?<![A-Za-z0-9_])(?:" + "|".join(_VERBS) + ")(?![A-Za-z0-9_])"
_OPEN = re.compile(r"(?:다|[.!?:;])[”’\"')\]]*\s*$")
_MARK = re.compile(r"^\s*(?:[•○●□■※]|[①-⓿]|\(?(?:[0-9]{1,3}|[A-Za-z]|[가-하])[.)])\s*")


def _dense(text: str) -> int:
    return len("".join(text.split()))


def is_sentence(piece: str) -> bool:
    """Whether a piece of text is a full, readable sentence, with or without a full stop or number."""
    core = _MARK.sub("", piece)
    if "<" in core or "&" in core:
        core = _TAG.sub(" ", core)
    core = core.strip()
    if len(core) < 10 or len(words := core.split()) < 3:
        return False
    if sum(map(len, _HANGUL.findall(core))) * 3 > len(core):
        said = bool(_KOREAN.search(core))
    else:
        said = len(words) >= 5 and bool(_VERB.search(core)) and len(_COMMON.findall(core)) >= 0.2 * len(words)
    return said and len(core) - len(_UNREADABLE.findall(core)) >= 0.75 * len(core)


def _blocks(text: str) -> list[str]:
    """The text's cells; a line that breaks off within a sentence goes on in the next."""
    out: list[str] = []
    held = ""
    for line in text.splitlines():
        if held and line.strip() and not _NEW.match(line) and not _CELLS.search(line.strip()):
            line = held + " " + line.strip()
        elif held:
            out.append(held)
        held = ""
        cells = [c for c in _CELLS.split(line.strip()) if c]
        if len(cells) == 1:
            # Long enough to be wrapped text, and not at a sentence's end.
            if len(cells[0].split()) >= 4 and not _OPEN.search(cells[0]):
                held = cells[0]
                continue
        out += cells
    if held:
        out.append(held)
    return out


def sentence_share(text: str | None) -> float:
    """The share of a text's non-space characters in full sentences; 0 for texts without such characters."""
    whole = _dense(text) if text else 0
    if not whole:
        return 0.0
    held = 0
    for block in _blocks(text):
        at = 0
        for end in [*(m.end() for m in _END.finditer(block)), len(block)]:
            piece = block[at:end]
            if end > at and is_sentence(piece):
                held += _dense(_TAG.sub(" ", piece) if "<" in piece or "&" in piece else piece)
            at = max(at, end)
    return held / whole


def sentence_share_column(text: Column) -> Column:
    """``sentence_share`` of a column; null is 0. Texts in which no sentence is possible do not reach a Python worker."""

    @F.pandas_udf(DoubleType())
    def shares(texts: pd.Series) -> pd.Series:
        return pd.Series([sentence_share(t) for t in texts], dtype="float64")

    return shares(F.when(text.rlike(POSSIBLE), text))


#: Published thresholds of rules on web text (word count, word length, symbols, bullets,
#: ellipses, letters, common words, punctuated lines), and this project's on sentences.
RULES = {
    "too_few_words": "words < 50",
    "too_many_words": "words > 100000",
    "word_length": "mean_word_length < if(hangul_share > 0.3, 2, 3) or mean_word_length > 10",
    "symbols": "symbol_ratio > 0.1",
    "bullets": "bullet_line_share > 0.9",
    "ellipses": "ellipsis_line_share > 0.3",
    "few_letters": "letter_word_share < 0.8",
    "few_common_words": "common_words < 2",
    "unpunctuated_lines": "punctuated_line_share < 0.12",
    "few_sentences": "sentence_share < 0.5",
}


def text_statistics(texts: DataFrame, key: str = "text_path", text: str = "text") -> DataFrame:
    """One row a row of ``texts``: key, the audit's counters and score, further statistics, ``failures``.

    Shares of nothing are 0, so null, empty and blank texts fail the rules on too little. ``failures``
    names every rule of ``RULES`` that the text fails, in their order. Columns other than the two named
    are not read. All statistics are Column expressions but ``sentence_share``, which alone needs a
    Python worker and costs nothing where it is not selected.
    """
    value = F.coalesce(F.col(text), F.lit(""))
    lined = texts.select(F.col(key), value.alias("__t"), text_lines(value).alias("__lines"))
    base = lined.select(key, "__t", F.array_join("__lines", "\n").alias("__flat"), *[c.alias(n) for n, c in quality.metrics(F.col("__t"), F.col("__lines")).items()])
    flagged = base.withColumn("__flags", quality.flags())
    share = lambda part, whole: F.when(whole > 0, part / whole).otherwise(0.0)
    counted = lambda column, pattern: F.regexp_count(column, F.lit(pattern))
    # Most characters and words are told by a first look at ranges, which does not change what is counted.
    common = f"(?=[A-Za-z])(?:{'|'.join(COMMON_EN)})|(?=[가-힣])(?:{'|'.join(COMMON_KO)})"
    edge = "[.,;:()“”\"']"
    stats = flagged.withColumn("__words", counted("__t", r"\S+")).select(
        key,
        *quality.metrics(value),
        quality.score(F.col("__flags")).alias("quality_score"),
        F.col("__words").cast("long").alias("words"),
        share(F.col("non_space_chars"), F.col("__words")).alias("mean_word_length"),
        share(F.length("__t") - F.length(F.regexp_replace("__t", "[가-힣]+", "")), F.col("non_space_chars")).alias("hangul_share"),
        share(counted("__t", r"#|\.\.\.|…"), F.col("__words")).alias("symbol_ratio"),
        share(counted("__t", r"(?![가-힣A-Za-z0-9 ])[^\p{L}\p{N}\s]"), F.col("non_space_chars")).alias("punctuation_share"),
        share(counted("__flat", r"(?md)^[^\S\n]*(?:[-*•●○■□▪※◦]|[①-⓿])"), F.col("line_count")).alias("bullet_line_share"),
        share(counted("__flat", r"(?md)(?:\.\.\.|…)$"), F.col("line_count")).alias("ellipsis_line_share"),
        share(counted("__flat", r"(?md)[.!?。][\"'”’)\]]*$"), F.col("line_count")).alias("punctuated_line_share"),
        share(counted("__t", r"(?<!\S)(?:[A-Za-z가-힣]|[^\s\p{L}]*+\p{L})"), F.col("__words")).alias("letter_word_share"),
        counted("__t", rf"(?i)(?<!\S){edge}*+(?:{common}){edge}*+(?!\S)").cast("long").alias("common_words"),
        sentence_share_column(F.col("__t")).alias("sentence_share"),
    )
    failed = F.filter(F.array(*[F.when(F.expr(rule), F.lit(name)) for name, rule in RULES.items()]), lambda r: r.isNotNull())
    return stats.withColumn("common_word_share", share(F.col("common_words"), F.col("words"))).withColumn("failures", failed)


def not_prose(texts: DataFrame, key: str = "text_path", text: str = "text", decisive: tuple[str, ...] = ("few_sentences",)) -> DataFrame:
    """(``key``, ``reason``, ``failures``) of the texts that fail one of the ``decisive`` rules, a row for each of these,
    with all rules that they fail.

    Every statistic and rule of ``text_statistics`` is computed for every text; which ones decide is a
    matter of what prose is. Here it is text whose sentences hold at least half of it.
    """
    # Unfolded first: a condition on the array itself would be pushed down and compute the statistics again.
    reasons = text_statistics(texts, key, text).select(key, "failures", F.explode_outer("failures").alias("reason"))
    return reasons.where(F.col("reason").isin(*decisive)).select(key, "reason", "failures")
