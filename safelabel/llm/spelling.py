"""Spelling variants: words one edit apart, found by walking a trie that is a table.

Method: relational trie frontier. The trie of all words is a distributed table of edges; a
node is the hash of a prefix, an edge takes up to ``STEP`` letters, the last one of a word
with its end. A state is (word, position, node, edits): the letters of the word before the
position have led to the node. States without edits need no join, as their node is the hash
of the word's own prefix. From each of them an edit makes states with one edit:
- a letter of the word is left out: same node, position one on;
- a letter is replaced: to a child by a later letter of the alphabet, position one on.
The third edit, an inserted letter, and replacements by earlier letters are the same pairs
seen from the other word. A state lives on only if an edge from its node has the next letters
of its word: an equality join on (node, letters), so shallow nodes are no hot keys and one
word meets at most one edge per letter of the alphabet. Level by level, all states take an
edge; one that takes an edge with an end has found a neighbour. Pairs are checked exactly
at the end, as nodes are hashes.

Words of ``LONG`` letters or more would make prefixes that grow with their square. They meet
each other by the hashes of themselves with one letter left out, one row a letter. A pair
with a word below ``LONG`` is found by the trie, which holds words of up to ``LONG`` letters.

A word's form is the near word that is commonest, if it is at least twice as common. Counts
double along forms, so chains are short; roots are found by joining forms to themselves.

Null texts have no words; a null doc_id counts as an empty string in the hash that decides
which letters are lost. Repeated rows count each. Texts are searched in blocks that end
between words, so a long text takes no more memory than a word. Extra columns are ignored.
An empty table gives an empty result.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from safelabel.llm.hashing import mix
from safelabel.llm.store import written

STEP = 4
LONG = 40
END = "$"
FLUSH_WORDS = 300_000
BLOCK = 1 << 20
_RUN = re.compile("[a-zÀ-ÿ]+")
_GAP = re.compile("[^a-zÀ-ÿ]")
_U = np.uint64


def runs_of(text: str) -> Counter:
    """How often each run of letters occurs; only A-Z are lower-cased."""
    text = text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")
    found: Counter = Counter()
    at = 0
    while at < len(text):
        gap = _GAP.search(text, at + BLOCK) if at + BLOCK < len(text) else None
        stop = gap.end() if gap else len(text)
        found.update(_RUN.findall(text, at, stop))
        at = stop
    return found


def mistyped(run: str, seed: int, every: int) -> str:
    """The run, or the run without one letter if ``every`` divides its checksum, which ``seed`` starts."""
    h = zlib.crc32(run.encode(), seed)
    return run if h % every else run[: h % len(run)] + run[h % len(run) + 1 :]


def _counted(frames: Iterator[pd.DataFrame], least: int, every: int) -> Iterator[pd.DataFrame]:
    total: Counter = Counter()

    def flush() -> pd.DataFrame:
        out = pd.DataFrame({"word": list(total), "n": list(total.values())})
        total.clear()
        return out

    for frame in frames:
        for doc, text in zip(frame["name"], frame["text"], strict=True):
            seed = zlib.crc32(f"{doc}:".encode())
            for run, n in runs_of(text).items():
                if len(run) >= least and len(word := mistyped(run, seed, every)) >= least:
                    total[word] += n
            if len(total) > FLUSH_WORDS:
                yield flush()
    if total:
        yield flush()


def counted_words(documents: DataFrame, least_letters: int = 5, least_count: int = 3, every: int = 97) -> DataFrame:
    """(word, n) of all documents."""
    rows = documents.where("text is not null").select(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("name"), "text")
    parts = rows.mapInPandas(lambda frames: _counted(frames, least_letters, every), "word string, n long")
    return parts.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least_count)


def _prefix(length) -> Column:
    return F.xxhash64(F.substring("whole", F.lit(1), length))


def _letters(start) -> Column:
    return F.substring("whole", start, F.lit(STEP))


def edges(words: DataFrame) -> DataFrame:
    """The trie's edges: (parent, letter, node, letters, child, ended); ``letter`` leads from the parent to the node.

    ``ended`` is the word that ends on the edge, or null.
    """
    ended = words.select("word", F.concat("word", F.lit(END)).alias("whole"))
    steps = ended.withColumn("depth", F.explode(F.sequence(F.lit(0), F.char_length("word"))))
    depth = F.col("depth")
    return steps.select(
        F.when(depth > 0, _prefix(depth - 1)).alias("parent"), F.when(depth > 0, F.substring("whole", depth, F.lit(1))).alias("letter"),
        _prefix(depth).alias("node"), _letters(depth + 1).alias("letters"), _prefix(depth + STEP).alias("child"),
        F.when(depth + STEP > F.char_length("word"), F.col("word")).alias("ended")).distinct()


def first_edits(words: DataFrame) -> DataFrame:
    """States of one edit before their first edge: (word, position, node, letters, replaced).

    ``replaced`` is the letter whose place another one takes, under the node; null where it is left out.
    Of a run of equal letters, the first is left out.
    """
    ended = words.select("word", F.concat("word", F.lit(END)).alias("whole"))
    steps = ended.withColumn("depth", F.explode(F.sequence(F.lit(0), F.char_length("word") - 1)))
    depth = F.col("depth")
    letter = F.substring("whole", depth + 1, F.lit(1))
    left_out = F.when((depth == 0) | (letter != F.substring("whole", depth, F.lit(1))), F.array(letter, F.lit(None).cast("string")))
    return steps.select(
        "word", (depth + 1).alias("position"), _prefix(depth).alias("node"), _letters(depth + 2).alias("letters"),
        F.explode(F.coalesce(left_out, F.array(letter))).alias("replaced"))


def trie_neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near) one edit apart of a table of words, each pair once, by the frontier over the trie."""
    trie = written(edges(words))
    down = trie.select("node", "letters", F.lit(None).cast("string").alias("letter"), "child", "ended")
    across = trie.where("parent is not null").select(F.col("parent").alias("node"), "letters", "letter", "child", "ended")
    start = first_edits(words)
    taken = start.join(down.union(across), ["node", "letters"]).where("letter > replaced or (letter is null and replaced is null)")
    frontier = written(taken.select("word", (F.col("position") + STEP).alias("position"), F.col("child").alias("node"), "ended"))
    found = frontier.where("ended is not null").select("word", F.col("ended").alias("near"))
    while not (alive := frontier.where("ended is null")).isEmpty():
        whole = F.concat("word", F.lit(END))
        ahead = alive.select("word", "position", "node", F.substring(whole, F.col("position") + 1, F.lit(STEP)).alias("letters"))
        frontier = written(ahead.join(trie.select("node", "letters", "child", F.col("ended")), ["node", "letters"]).select(
            "word", (F.col("position") + STEP).alias("position"), F.col("child").alias("node"), "ended"))
        found = found.union(frontier.where("ended is not null").select("word", F.col("ended").alias("near")))
    return found.where("levenshtein(word, near) = 1")


_CODE = _U(0x9FB21C651E98DF25)


def _left_out(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(print, size, place) of each word, whole at place -1 and with each letter left out."""
    for frame in frames:
        for name, word in zip(frame["name"], frame["word"], strict=True):
            code = mix(np.frombuffer(word.encode("utf-32-le"), np.uint32).astype(_U) + _U(1))
            n = len(code)
            power = np.full(n, _CODE, _U)
            power[0] = 1
            np.multiply.accumulate(power, out=power)
            before = np.concatenate([[_U(0)], np.cumsum(code * power)])
            after = np.concatenate([np.cumsum((code[1:] * power[:-1])[::-1])[::-1], [_U(0)]]) if n > 1 else np.zeros(1, _U)
            for at in range(0, n, BLOCK):
                stop = min(n, at + BLOCK)
                yield pd.DataFrame({"name": name, "print": mix(before[at:stop] + after[at:stop]).astype(np.int64), "size": n - 1, "place": np.arange(at, stop)})
            yield pd.DataFrame({"name": [name], "print": mix(before[-1:]).astype(np.int64), "size": n, "place": -1})


def long_neighbours(words: DataFrame) -> DataFrame:
    """Pairs (word, near) one edit apart of a table of long words, each pair at least once."""
    named = written(words.select(F.xxhash64("word").alias("name"), "word"))
    prints = written(named.mapInPandas(_left_out, "name long, print long, size int, place int"))
    shorter = prints.where("place < 0").select("print", "size", F.col("name").alias("other"))
    replaced = prints.where("place >= 0").select("print", "size", "place", F.col("name").alias("other"))
    lost = prints.where("place >= 0").join(shorter, ["print", "size"]).select("name", "other")
    pairs = lost.union(prints.join(replaced, ["print", "size", "place"]).where("name < other").select("name", "other")).distinct()
    return (pairs.join(named, "name").join(named.select(F.col("name").alias("other"), F.col("word").alias("near")), "other")
            .where("levenshtein(word, near, 1) = 1").select("word", "near"))


def neighbours(words: DataFrame) -> DataFrame:
    """All pairs (word, near) one edit apart, each in both directions, of a table of distinct words."""
    size = F.char_length("word")
    far = words.where(size >= LONG)
    pairs = trie_neighbours(words.where(size <= LONG))
    if not far.isEmpty():
        pairs = pairs.union(long_neighbours(far))
    return pairs.union(pairs.select(F.col("near").alias("word"), F.col("word").alias("near"))).distinct()


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last word that forms lead to. Forms must not lead in circles."""
    now = written(forms.select("word", F.col("form").alias("root")))
    while True:
        onward = now.select(F.col("word").alias("root"), F.col("root").alias("next"))
        joined = now.join(onward, "root", "left")
        now = written(joined.select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")))
        if now.where("moved").isEmpty():
            return now.select("word", "root")
        now = now.select("word", "root")


def variants(documents: DataFrame, least_letters: int = 5, least_count: int = 3, ratio: int = 2, every: int = 97) -> DataFrame:
    """(word, form, root, n, n_near, form_n) of every word; see the module."""
    words = written(counted_words(documents, least_letters, least_count, every))
    near = neighbours(words.select("word")).join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near")
    best = written(near.groupBy("word").agg(F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")))
    joined = words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.expr(f"case when -best.less >= {ratio} * n then best.near end").alias("form"), F.expr(f"case when -best.less >= {ratio} * n then -best.less end").alias("form_n"))
    told = written(joined)
    ends = roots(told.where("form is not null").select("word", "form"))
    return told.join(ends, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
