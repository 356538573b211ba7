"""Text that was decoded with the wrong character encoding."""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.cluster import broadcast_if_small, checkpoint

#: Encodings that text was written in, and those that it may have been read in by mistake.
WRITTEN = ("utf-8", "cp949")
READ = ("latin-1", "cp1252", "mac_roman", "cp437", "cp949", "gbk", "big5", "cp932", "euc_jp", "cp1251", "koi8_r", "utf-8")
#: Readings that were written and misread once more.
TWICE = (("utf-8", "cp1252"), ("utf-8", "latin-1"))
#: Runs of characters beyond ASCII: what a wrong encoding changes, while the ASCII between them stays.
RUN = r"[^\x00-\x7F]+"
#: Words that mix ASCII letters with others: a letter with a diacritic may be misread as a Hangul syllable.
_LETTER = "À-ÖØ-öø-ɏ가-힣"
MIXED = rf"[A-Za-z]*(?:[{_LETTER}]+[A-Za-z]+)+[{_LETTER}]*|[A-Za-z]+[{_LETTER}]+"
_TOUCHING = rf"[A-Za-z][{_LETTER}]|[{_LETTER}][A-Za-z]"
_LATIN_WORD = r"^(?=.*[A-Za-z])[A-Za-zÀ-ÖØ-öø-ſ]+$"
_HANGUL_MIX = r"^(?=.*[A-Za-z])[A-Za-z가-힣]+$"
#: Characters that make a run an ordinary one: Hangul, punctuation, enumeration signs, symbols, Greek.
PLAIN = r"\u00A0가-힣ㄱ-ㆎ·§°±×÷‐-‧‰-⁞⁰-₿℀-⅏←-⇿∀-⋿①-⓿─-◿☀-☕✓✔　-〿㈀-㏿！-￮Α-Ωα-ω"
_PLAIN_RUN = f"^[{PLAIN}]+$"
_BROKEN = re.compile("[\x80-\x9f�]")


def _misread(data: bytes, encoding: str) -> set[str]:
    """The texts that readers of an encoding make of bytes: with what is undefined kept as control
    characters, replaced, or dropped."""
    out = set()
    if encoding == "cp1252":
        kept = "".join(bytes([b]).decode("cp1252", "ignore") or chr(b) for b in data)
        out.add(kept)
    for errors in ("replace", "ignore") if encoding != "utf-8" else ("replace",):
        out.add(data.decode(encoding, errors))
    return out


def garbled_forms(word: str) -> dict[str, str]:
    """Every garbled form of a word and the chain of encodings that makes it, the first of several."""
    out: dict[str, str] = {}

    def once(text: str, chain: str, pairs: tuple[tuple[str, str], ...]) -> list[tuple[str, str]]:
        made = []
        for written, read in pairs:
            if written == read:
                continue
            try:
                data = text.encode(written)
            except UnicodeEncodeError:
                continue
                # Text that is valid UTF-8 was not damaged by reading it as such, but repaired.
            made += [(form, f"{chain}{written}>{read}") for form in sorted(_misread(data, read)) if form and form != text and (read != "utf-8" or "�" in form)]
        return made

    singles = tuple((w, r) for w in WRITTEN for r in READ)
    for form, chain in once(word, "", singles):
        out.setdefault(form, chain)
    for form, chain in once(word, "", TWICE):
        for again, longer in once(form, f"{chain}+", TWICE):
            out.setdefault(again, longer)
    return out


def _strong(form: str) -> bool:
    """Whether one such run alone proves the damage: it holds characters that no text has or two lost
    ones, or signs beside letters, or is too long to be letters of a name."""
    if form.count("�") == len(form):
        return len(form) >= 2
    return len(form) >= 2 and not form.isalpha() or len(form) >= 4 or bool(re.search("[A-Za-z]", form))


def _table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    ordinary, mixed, latin = re.compile(_PLAIN_RUN), re.compile(_HANGUL_MIX), re.compile(_LATIN_WORD)
    for batch in batches:
        forms, words, chains, strong = [], [], [], []
        for word in batch.column(0).to_pylist():
            for form, chain in garbled_forms(word).items():
                # A form that is itself ordinary, or holds ASCII and so is no run, is never looked up;
                # of words with ASCII letters only forms that pass for a Hangul mixture are.
                if not mixed.match(form) if latin.match(word) else ordinary.match(form) or any(c < "\x80" for c in form):
                    continue
                forms.append(form)
                words.append(word)
                chains.append(chain)
                strong.append(_strong(form))
        yield pa.RecordBatch.from_arrays([pa.array(forms, pa.string()), pa.array(words, pa.string()), pa.array(chains, pa.string()), pa.array(strong, pa.bool_())], names=["form", "word", "chain", "strong"])


def runs(text: Column) -> Column:
    """The distinct runs beyond ASCII and mixed words of a text."""
    mixed = F.when(text.rlike(_TOUCHING), F.regexp_extract_all(text, F.lit(MIXED), F.lit(0)))
    return F.array_union(F.regexp_extract_all(text, F.lit(RUN), F.lit(0)), F.coalesce(mixed, F.array().cast("array<string>")))


def matches(texts: DataFrame, key: str = "text_path", text: str = "text") -> DataFrame:
    """(``key``, ``form``, ``chain``, ``words``, ``word``, ``strong``): garbled runs of texts, with how many clean
    words have this form under the chain, and the least of them.

    The words are all distinct ordinary runs of the corpus, single letters with a diacritic and Latin
    words with one. Their garbled forms under every chain make a table, against which the runs that are not ordinary are
    hash-joined.
    """
    known = texts.where(F.col(key).isNotNull() & F.col(text).rlike(r"[^\x00-\x7F]")).select(F.col(key).alias("key"), F.col(text).alias("text"))
    every = known.select(F.explode(runs(F.col("text"))).alias("run")).distinct()
    words = every.where(F.col("run").rlike(_PLAIN_RUN) | F.col("run").rlike(r"^[À-ÖØ-öø-ſ]$") | F.col("run").rlike(_LATIN_WORD))
    table = words.mapInArrow(_table, "form string, word string, chain string, strong boolean")
    forms = table.groupBy("form", "chain").agg(F.countDistinct("word").alias("words"), F.min("word").alias("word"), F.max("strong").alias("strong"))
    # Most texts have ordinary runs only and are passed over by their characters.
    suspect = known.where(F.col("text").rlike(rf"[^\x00-\x7F{PLAIN}]") | F.col("text").rlike(_TOUCHING))
    odd = suspect.select("key", F.explode(F.filter(runs(F.col("text")), lambda r: ~r.rlike(_PLAIN_RUN) & (~r.rlike("[A-Za-z]") | r.rlike(_HANGUL_MIX)))).alias("form"))
    return odd.join(forms, "form").withColumnRenamed("key", key)


def garbled(texts: DataFrame, key: str = "text_path", text: str = "text") -> DataFrame:
    """(``key``, ``chain``, ``forms``) of every text with a passage that was decoded wrongly.

    A text is affected if one of its runs is a garbled form that no name or symbol is mistaken for, or
    two different ones are weaker forms under one chain. ``chain`` is the one that explains most runs.
    Null keys or texts, and texts in plain ASCII, are not affected. Repeated rows are one.
    """
    found = matches(texts, key, text)
    chains = found.groupBy(key, "chain").agg(F.countDistinct("form").alias("forms"), F.max("strong").alias("strong"))
    judged = chains.where(F.col("strong") | (F.col("forms") >= 2))
    best = F.max(F.struct("forms", "strong", "chain")).alias("best")
    return judged.groupBy(key).agg(best).select(key, F.col("best.chain").alias("chain"), F.col("best.forms").alias("forms"))


def restored(texts: DataFrame, key: str = "text_path", text: str = "text", max_broadcast: int = 100_000) -> DataFrame:
    """(``key``, ``chain``, ``restored``, ``replaced_runs``, ``lost_runs``) of every affected text.

    Each garbled run of which the text's chain has one original is replaced by it. Runs with several
    originals (lossy readings) and runs whose original is nowhere clean in the corpus stay as they are;
    ``lost_runs`` counts the different ones.
    """
    found = checkpoint(matches(texts, key, text))
    chains = found.groupBy(key, "chain").agg(F.countDistinct("form").alias("forms"), F.max("strong").alias("strong")).where(F.col("strong") | (F.col("forms") >= 2))
    best = chains.groupBy(key).agg(F.max(F.struct("forms", "strong", "chain")).alias("best")).select(key, F.col("best.chain").alias("chain"))
    swaps = found.join(best, [key, "chain"]).where("words = 1").groupBy(key, "chain").agg(F.map_from_entries(F.collect_list(F.struct("form", "word"))).alias("swaps"))
    # A text's own runs bound its map.
    # Only affected texts move: their keys are few beside all texts, and are broadcast where that is proven.
    keys, _ = broadcast_if_small(checkpoint(best.select(key)), max_broadcast)
    affected = texts.where(F.col(text).isNotNull()).select(key, F.col(text).alias("text")).join(keys, key, "left_semi").dropDuplicates([key])
    with_swaps = best.join(swaps, [key, "chain"], "left").join(affected, key)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        run, mixed, ordinary = re.compile(RUN), re.compile(MIXED), re.compile(_PLAIN_RUN)
        for batch in batches:
            out, replaced, lost = [], [], []
            for swap, original in zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                known = dict(swap or ())
                odd = {r for r in run.findall(original) if not ordinary.match(r)}
                swapped = lambda m, known=known: known.get(m.group(), m.group())
                out.append(run.sub(swapped, mixed.sub(swapped, original)))
                replaced.append(len(odd & known.keys()))
                lost.append(len(odd - known.keys()))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(out, pa.string()), pa.array(replaced, pa.int32()), pa.array(lost, pa.int32())], names=[key, "chain", "restored", "replaced_runs", "lost_runs"])

    kind = dict(texts.dtypes)[key]
    return with_swaps.select(key, "chain", "swaps", "text").mapInArrow(apply, f"{key} {kind}, chain string, restored string, replaced_runs int, lost_runs int")
