"""Spelling variants: words one edit apart, found by integer pairs of trie nodes.

Counting: tasks count the runs of their texts and the counts are added by word.
Numbering: words are sorted over ranges, and a word's prefixes get the numbers
of the nodes of a trie, node by node from the common prefix with the word
before; the nodes on the path to a range's last word have numbers that later
ranges know too, so equal prefixes have one number over all ranges.  Reversed
words give the numbers of suffixes the same way.

Pairs: a word of L letters has, for each i, the pair (prefix of i, suffix of
L-i-1), which skips letter i, and the pair (prefix of i, suffix of L-i), which
skips nothing.  Words that share a skipping pair differ in the letter replaced
there; a word whose whole pair is another's skipping pair lacks the letter that
is inserted there.  Numbers stand for whole prefixes and suffixes, so pairs meet
exactly and nothing needs to be verified.  A pair is shared by at most one word
for each letter of the alphabet and one more, however many words there are.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stayframe.llm.common import discard, documents, record_batch, slices, store, texts

LETTERS = "a-zÀ-ÿ"  # of lower-cased text
LEAST_LETTERS = 6
LEAST_COUNT = 5
TIMES = 5  # a form is so much more frequent than its variant
ERRORS_EVERY = 199
RANGE_WORDS = 100_000
_SLICE = 4 << 20
_HELD = 500_000  # distinct words a task holds before it passes their counts on
_LOCAL = 1 << 39  # first number of the nodes that only one range knows
_WORDS = pa.schema([("word", pa.string()), ("n", pa.int64())])


def runs(text: bytes, pattern: re.Pattern, budget: int = _SLICE):
    """Counts of the pattern's matches in the text with A-Z lowered, part by part; parts end beside a byte of no run."""
    at = 0
    while at < len(text):
        end = at + budget
        while end < len(text) and (text[end] >= 0x80 or chr(text[end]).isalpha()):
            end += 1
        yield Counter(pattern.findall(text[at:end].lower().decode(errors="replace")))
        at = end


def word_counts(df: DataFrame, least_letters: int = LEAST_LETTERS, errors_every: int = ERRORS_EVERY) -> DataFrame:
    """word, n: runs of letters of all texts, A-Z lowered, of ``least_letters`` or more code points.

    Where ``errors_every`` divides the crc32 of '<doc_id>:<run>', that code point of the run goes
    whose number is the crc32 modulo the run's length.  A null id counts as ''.
    """
    def run(batches):
        pattern, held = re.compile(f"[{LETTERS}]{{{least_letters},}}"), {}

        def counted():
            out = record_batch(_WORDS, list(held), list(held.values()))
            held.clear()
            return out

        for whole in batches:
            for batch in slices(whole, 1, _SLICE):
                for doc_id, text in zip(batch.column(0).to_pylist(), texts(batch)):
                    seed = zlib.crc32(b"%d:" % doc_id if doc_id is not None else b":")
                    for part in runs(text, pattern):
                        for word, n in part.items():
                            h = zlib.crc32(word.encode(), seed)
                            if h % errors_every == 0:
                                cut = h % len(word)
                                word = word[:cut] + word[cut + 1:]
                                if len(word) < least_letters:
                                    continue
                            held[word] = held.get(word, 0) + n
                    if len(held) > _HELD:
                        yield counted()
        if held:
            yield counted()

    return documents(df).mapInArrow(run, "word string, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


def common(a: str, b: str) -> int:
    """Length of the common prefix."""
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    low, high = 0, n  # a[:low] is common, a[:high] is not
    while high - low > 1:
        mid = (low + high) // 2
        if a[low:mid] == b[low:mid]:
            low = mid
        else:
            high = mid
    return low


class Borders:
    """Each range's last word and the numbers on the path to it.

    The prefix of p letters belongs to the first range whose last word has it:
    (range << 40) + p.  A path is held as the ranges that own its parts.
    """

    def __init__(self, last: list[str]):
        self.last = last
        self.owners: list[list[tuple[int, int]]] = []  # per range: (prefixes up to here, owner)
        for k, word in enumerate(last):
            shared = common(last[k - 1], word) if k else 0
            own = [(min(to, shared), j) for at, (to, j) in enumerate(self.owners[-1])
                   if not at or self.owners[-1][at - 1][0] < shared] if shared else []
            self.owners.append([*own, (len(word), k)] if len(word) > shared else own)

    def path(self, k: int) -> list[int]:
        """Numbers of the prefixes of 0, 1, ... letters of range k's last word; the empty prefix is -1."""
        out = [-1]
        for to, owner in self.owners[k]:
            out.extend((owner << 40) + p for p in range(len(out), to + 1))
        return out


def trie_nodes(words: DataFrame, key: str, ranges: int) -> DataFrame:
    """part, place, all columns of ``words`` and nodes: the trie's numbers of the prefixes of 0, 1, ... letters of ``key``.

    (part, place) follows the order of ``key``, whose values must be distinct.
    """
    dealt = words.repartitionByRange(ranges, key).sortWithinPartitions(key)
    ordered = store(dealt.select(F.spark_partition_id().alias("part"), "*"), "ordered")
    ends = ordered.groupBy("part").agg(F.max(key).alias("last")).orderBy("part").collect()
    rank = {r["part"]: k for k, r in enumerate(ends)}
    share = words.sparkSession.sparkContext.broadcast((rank, Borders([r["last"] for r in ends])))
    names = ["part", *words.columns]
    at = names.index(key)

    def run(batches):
        rank, borders = share.value
        part = None
        for batch in batches:
            places, nodes = [], []
            for p, word in zip(batch.column(0).to_pylist(), batch.column(at).to_pylist()):
                if p != part:
                    part, k, place, made = p, rank[p], 0, (rank[p] << 40) + _LOCAL
                    before, last, toward = "", borders.last[k], borders.path(k)
                    held = [-1]
                    if k:
                        before, held = borders.last[k - 1], borders.path(k - 1)
                shared, on_path = common(before, word), common(word, last)
                held = held[:shared + 1]
                if on_path > shared:
                    held += toward[shared + 1:on_path + 1]
                fresh = len(word) + 1 - len(held)
                held += range(made, made + fresh)
                made += fresh
                places.append(place)
                nodes.append(held)
                before, place = word, place + 1
            columns = [*batch.columns, pa.array(places, pa.int64()), pa.array(nodes, pa.list_(pa.int64()))]
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "place", "nodes"])

    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in ordered.schema)
    out = ordered.repartition("part").sortWithinPartitions("part", key).mapInArrow(
        run, f"{kinds}, place bigint, nodes array<bigint>")
    out.made_from = ordered
    return out


_PAIRS = pa.schema([("a", pa.int64()), ("b", pa.int64()), ("id", pa.int64()), ("n", pa.int64()), ("whole", pa.bool_()),
                    ("first", pa.bool_())])


def node_pairs(words: DataFrame) -> DataFrame:
    """a, b, id, n, whole, first of (id, word, n, f, r): the pairs that skip a letter, and the whole ones.

    ``first`` marks the skipped letter that differs from the one before it: of equal letters in a
    row, inserting or deleting any gives the same word, so that it is found once.
    """
    def run(batches):
        for batch in batches:
            a, b, rows, whole, first = [], [], [], [], []
            ids, n = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            for row, (word, f, r) in enumerate(zip(*(batch.column(c).to_pylist() for c in (1, 3, 4)))):
                size = len(word)
                back = r[::-1]  # back[i] is the suffix that starts at letter i
                a += f[:size] + f
                b += back[1:] + back
                whole += [False] * size + [True] * (size + 1)
                first += [i == 0 or word[i] != word[i - 1] for i in range(size)] + [False] * (size + 1)
                rows += [row] * (2 * size + 1)
                if len(a) > 200_000:
                    yield record_batch(_PAIRS, a, b, ids[rows], n[rows], whole, first)
                    a, b, rows, whole, first = [], [], [], [], []
            if a:
                yield record_batch(_PAIRS, a, b, ids[rows], n[rows], whole, first)

    return words.select("id", "word", "n", "f", "r").mapInArrow(
        run, "a bigint, b bigint, id bigint, n bigint, whole boolean, first boolean")


def neighbours(pairs: DataFrame) -> DataFrame:
    """id, n_near, top (n and id of the near word with the largest n, ties to the smaller id)."""
    shared = (pairs.groupBy("a", "b").agg(F.collect_list(F.struct("n", "id", "whole", "first")).alias("all"))
              .where(F.size("all") > 1))
    member = shared.select("all", F.explode("all").alias("m"))
    m = F.col("m")
    # a replaced letter: both skip it; an inserted one: one skips it (once for letters in a row), the other is whole
    near = F.filter("all", lambda x: (x["id"] != m["id"]) & F.when(m["whole"], x["first"])
                    .when(x["whole"], m["first"]).otherwise(F.lit(True)))
    met = member.select(m["id"].alias("id"), near.alias("near")).where(F.size("near") > 0)
    best = F.array_max(F.transform("near", lambda x: F.struct(x["n"].alias("n"), (-x["id"]).alias("back"))))
    return (met.select("id", F.size("near").cast("bigint").alias("k"), best.alias("best"))
            .groupBy("id").agg(F.sum("k").alias("n_near"), F.max("best").alias("best"))
            .select("id", "n_near", F.col("best.n").alias("top_n"), (-F.col("best.back")).alias("top")))


def roots(forms: DataFrame) -> DataFrame:
    """id, root of (id, form): the end of each chain of forms.  Each round doubles the steps taken."""
    jump = store(forms.select("id", F.col("form").alias("root")), "roots")
    while True:
        on = jump.select(F.col("id").alias("root"), F.col("root").alias("next"))
        step = store(jump.join(on, "root", "left").select("id", F.coalesce("next", "root").alias("root"),
                                                         F.col("next").isNotNull().alias("moved")), "roots")
        more = step.where("moved").limit(1).count()
        discard(jump)
        jump = step
        if not more:
            return jump


def variants(df: DataFrame, least_letters: int = LEAST_LETTERS, least_count: int = LEAST_COUNT, times: int = TIMES,
             errors_every: int = ERRORS_EVERY, range_words: int = RANGE_WORDS) -> DataFrame:
    """One row per word: word, form, root, n, n_near, form_n.

    ``n_near`` counts the words that differ by one inserted, deleted or replaced
    code point.  ``form`` is the near word with the largest n, ties to the first in
    code-point order, if it has at least ``times`` the word's own n, else null (and
    ``form_n`` too); ``root`` follows forms to the last, or is the word itself.

    Nulls: a null text has no words; a null id counts as '' in the hash.  Rows that
    repeat, or share an id, count as often as they come.  Empty texts or an empty
    table give no rows.  Very long texts are read in parts that cut no run; a run
    may be of any length, its work grows with its letters.  Other columns, whatever
    their names, are ignored.
    """
    spark = df.sparkSession
    words = store(word_counts(df, least_letters, errors_every).where(F.col("n") >= least_count), "words")
    ranges = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-words.count() // range_words))
    forward = trie_nodes(words, "word", ranges)
    # ids follow the order of words, so that ties of n go to the smaller id
    numbered = store(forward.select(F.expr("(CAST(part AS BIGINT) << 40) + place").alias("id"), "word", "n",
                                    F.col("nodes").alias("f")), "numbered")
    discard(forward.made_from, words)
    backward = trie_nodes(numbered.select("id", F.reverse("word").alias("drow")), "drow", ranges)
    both = numbered.join(backward.select("id", F.col("nodes").alias("r")), "id")
    near = store(neighbours(node_pairs(both)), "near")
    discard(backward.made_from)
    plain = numbered.select("id", "word", "n")
    known = plain.join(near, "id", "left")
    forms = store(known.where(F.col("top_n") >= times * F.col("n")).select("id", F.col("top").alias("form"),
                                                                        F.col("top_n").alias("form_n")), "forms")
    ends = roots(forms).select("id", "root")
    name = plain.select("id", "word")
    named = (forms.join(ends, "id")
             .join(name.select(F.col("id").alias("form"), F.col("word").alias("form_word")), "form")
             .join(name.select(F.col("id").alias("root"), F.col("word").alias("root_word")), "root")
             .select("id", "form_word", "root_word", "form_n"))
    return (plain.join(near.select("id", "n_near"), "id", "left").join(named, "id", "left")
            .select("word", F.col("form_word").alias("form"), F.coalesce("root_word", "word").alias("root"), "n",
                    F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"), "form_n"))
