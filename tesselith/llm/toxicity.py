"""Toxicity by a weighted finite-state pattern grammar.

Words fall into classes: insult, threat, target, negation, reported speech, other. Four small transducers
(offence with target, threat with target, negation, reported speech) read the classes of a clause; their composition is one
table from state and class to state and weight. A clause scores what the composed machine emits over it, a text scores
over its clauses, so that an offence that is negated or only reported counts less than one aimed at somebody.

The offences are learned by counts over the labelled training rows, MOST_LABELS of them at most: whole words, and stems where
words branch, that is, beginnings of which no single continuation accounts for most; frequent in texts labelled toxic and rare in others. Each toxic
text speaks only for the offence in it that has the best odds, so that words that merely stand beside offences are not learned. An offence
needs MIN_TEXTS such texts, whatever their share, and odds that hold on the careful side of both counts; its log-odds are the arc
weight. MOST_STEMS candidates, those with the best odds, bound the table. A whole word of five letters or more stands for its
inflections, up to ENDING letters longer, but for words that clean texts have.

Defined cases: null and empty texts score PRIOR; rows with null labels teach nothing; a doc_id that is labelled twice as
different kinds counts in both; repeated rows stay rows; without labels only the fixed words count; an empty table
gives an empty result. label, lang, source and doc_id are not inputs of a score.
"""

from __future__ import annotations

import math
import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import stored, table

THRESHOLD = 0.3
PRIOR = 0.03
#: A stem is in so many toxic training texts at least, and in this ratio to the clean ones.
MIN_TEXTS, RATIO = 5, 5.0
#: Most candidates for stems, by their odds, that reach the driver (about 30 bytes each).
MOST_STEMS = 200_000
LEAST_LETTERS, LEAST_INFLECTED, ENDING = 3, 5, 3
#: Lengths of stems, and how much oftener than its most frequent continuation a stem has to be.
STEM_LENGTHS, BRANCHING = range(4, 9), 1.25
#: A beginning is less sure than a word: so much of its log-odds counts (from training rows: 0.95 of what is found is toxic, 0.73 at 1).
SURENESS = 0.5
#: Most labelled rows to learn from; of more, those whose doc_id has the least hashes. So many rows (12 bytes each) are broadcast.
MOST_LABELS = 200_000

TARGET = "you your u he she they them him her her's du dich dir ihr euch sie er tu toi te vous il elle ils tú ti usted ustedes él ella ellos".split()
NEGATION = "not no never isn't aren't don't nicht kein keine nie niemals pas jamais aucun nunca jamás ningún".split()
REPORT = "said says say quoted quote wrote called claimed sagte schrieb zitat dit disait écrit dijo dice escribió citó".split()
THREAT = "kill hurt destroy murder beat burn töten schlagen umbringen tuer frapper détruire matar golpear destruir".split()

OTHER, INSULT, THREATS, TARGETS, NEG, REP = range(6)
CLAUSE = re.compile(r"[.!?;:,\n]+")
TOKEN = re.compile(r"[^\W\d_]+(?:'[^\W\d_]+)?")


class Transducer:
    """arcs: (state, class) -> (state, weight, factor); anything else stays and emits nothing."""

    def __init__(self, arcs: dict):
        self.arcs = arcs

    def step(self, state: int, kind: int):
        return self.arcs.get((state, kind), (state, 0.0, 1.0))


#: Weight of an offence is its own (1 here stands for it); a target on either side adds.
OFFENCE = Transducer({(0, INSULT): (1, 1.0, 1.0), (1, INSULT): (1, 1.0, 1.0), (0, TARGETS): (2, 0.0, 1.0), (2, INSULT): (1, 1.25, 1.0), (1, TARGETS): (2, 0.25, 1.0)})
#: A threat counts only together with a target.
THREATENING = Transducer({(0, TARGETS): (1, 0.0, 1.0), (1, THREATS): (2, 0.5, 1.0), (0, THREATS): (3, 0.0, 1.0), (3, TARGETS): (2, 0.5, 1.0)})
#: Negation damps what follows in its clause.
NEGATING = Transducer({(0, NEG): (1, 0.0, 1.0), (1, INSULT): (1, 0.0, 0.6), (1, THREATS): (1, 0.0, 0.3)})
REPORTING = Transducer({(0, REP): (1, 0.0, 1.0), (1, INSULT): (1, 0.0, 0.7), (1, THREATS): (1, 0.0, 0.4)})


def compose(*parts: Transducer) -> dict:
    """One table over tuples of states that can be reached: weights add, factors multiply."""
    start = (0,) * len(parts)
    out, todo = {}, [start]
    while todo:
        state = todo.pop()
        if state in out:
            continue
        row = []
        for kind in range(6):
            steps = [t.step(s, kind) for t, s in zip(parts, state)]
            row.append((tuple(x[0] for x in steps), sum(x[1] for x in steps), math.prod(x[2] for x in steps)))
            todo.append(row[-1][0])
        out[state] = row
    return out


class Grammar:
    """stems: weights of offences. Those with a star at the end are beginnings of words, others are words and begin their
    inflections; the weight is 0 for a word that is none although it begins like one."""

    def __init__(self, stems: dict[str, float]):
        import ahocorasick

        self.table = compose(OFFENCE, THREATENING, NEGATING, REPORTING)
        self.words = {s: w for s, w in stems.items() if not s.endswith("*")}
        self.stems = {s[:-1]: w for s, w in stems.items() if s.endswith("*")}
        self.lengths = sorted({len(s) for s in self.stems})
        self.fixed = {w: k for ws, k in ((TARGET, TARGETS), (NEGATION, NEG), (REPORT, REP), (THREAT, THREATS)) for w in ws}
        self.find = ahocorasick.Automaton()
        for s in {*(s for s, w in self.words.items() if w), *self.stems, *THREAT}:
            self.find.add_word(s, len(s))
        if len(self.find):
            self.find.make_automaton()

    def kind(self, word: str) -> tuple[int, float]:
        w = self.words.get(word)
        if w is None:
            inflected = (self.words.get(word[:n], 0.0) for n in range(max(LEAST_INFLECTED, len(word) - ENDING), len(word)))
            begun = (self.stems.get(word[:n], 0.0) for n in self.lengths if n <= len(word))
            w = max((*inflected, *begun), default=0.0)
        return (INSULT, w) if w else (self.fixed.get(word, OTHER), 4.0)

    def clause(self, text: str) -> float:
        state, total = (0,) * 4, 0.0
        for word in TOKEN.findall(text):
            kind, weight = self.kind(word)
            state, w, factor = self.table[state][kind]
            total += w * weight * factor
        return total

    def score(self, text: str | None) -> float:
        """Log-odds of the prior and of the clauses' sum, as a probability."""
        low = (text or "").lower()
        if not low or not len(self.find):
            return PRIOR
        total, done = 0.0, 0
        for end, n in self.find.iter(low):
            begin = end - n + 1
            if begin < done or (begin and low[begin - 1].isalpha()):
                continue
            a = max((m.end() for m in CLAUSE.finditer(low, done, begin)), default=done)
            stop = CLAUSE.search(low, end + 1)
            done = stop.end() if stop else len(low)
            total += self.clause(low[a:done])
        return 1 / (1 + math.exp(min(50.0, -(math.log(PRIOR / (1 - PRIOR)) + total))))


def words(text: Column) -> Column:
    """The distinct words of a text."""
    return F.filter(F.array_distinct(F.split(F.lower(text), "[^\\p{L}]+")), lambda w: F.length(w) >= LEAST_LETTERS)


def _begun(some: Column, longest: int) -> Column:
    """Words with all their beginnings (a star at the end) of the lengths of stems, up to longest, each once."""
    lengths = lambda w: F.sequence(F.lit(STEM_LENGTHS[0]), F.least(F.length(w), F.lit(longest)))
    cut = F.transform(F.filter(some, lambda w: F.length(w) >= STEM_LENGTHS[0]), lambda w: F.transform(lengths(w), lambda n: F.concat(F.substr(w, F.lit(1), n), F.lit("*"))))
    return F.array_distinct(F.concat(some, F.flatten(cut)))


def learn_stems(labelled: DataFrame) -> dict[str, float]:
    """labelled: text, toxic. Offence to log-odds, and 0 for words of clean texts that only begin like one."""
    labelled = labelled.where("toxic is not null and text is not null")
    totals = {r[0]: r[1] for r in labelled.groupBy(F.col("toxic") == 1).count().collect()}
    n_toxic, n_clean = totals.get(True, 0), totals.get(False, 0)
    if not n_toxic:
        return {}
    longest = STEM_LENGTHS[-1] + 1
    toxic = stored(labelled.where("toxic = 1").select(F.monotonically_increasing_id().alias("i"), F.explode(_begun(words(F.col("text")), longest)).alias("key")), "words")
    counts = stored(toxic.groupBy("key").agg(F.count("*").alias("t")).where(F.col("t") >= MIN_TEXTS), "counts")
    # of a beginning the most frequent continuation: by a letter, or as a word that ends here
    bare = F.rtrim("key", F.lit("*"))
    starred = F.endswith("key", F.lit("*"))
    parent = F.concat(F.when(starred, F.substr(bare, F.lit(1), F.length(bare) - 1)).otherwise(bare), F.lit("*"))
    most = counts.groupBy(parent.alias("key")).agg(F.max("t").alias("most"))
    seen = counts.join(most, "key", "left").where(~starred | ((F.length(bare) < longest) & (F.col("t") >= BRANCHING * F.coalesce("most", F.lit(0)))))
    clean = stored(labelled.where("toxic != 1").select(F.explode(words(F.col("text"))).alias("s")).groupBy("s").agg(F.count("*").alias("c")), "words")
    # a beginning's texts are no more than its words' texts: a bound that serves here, as offences are in almost no clean text
    held = clean.withColumn("key", F.explode(_begun(F.array("s"), STEM_LENGTHS[-1]))).join(seen.select("key"), "key").groupBy("key").agg(F.sum("c").alias("c"))
    rows = seen.join(held, "key", "left").withColumn("c", F.coalesce("c", F.lit(0)))
    careful = lambda t, c: F.log((F.greatest(F.lit(0.5), t - 1.5 * F.sqrt(t))) / (n_toxic + 1)) - F.log((c + 1 + 1.5 * F.sqrt(c + 1)) / (n_clean + 1))
    rows = rows.withColumn("w", careful(F.col("t"), F.col("c"))).where(F.col("w") >= math.log(RATIO)).orderBy(F.col("w").desc(), "key").limit(MOST_STEMS)
    rows = stored(rows, "candidates")
    best = toxic.join(F.broadcast(rows.select("key", "w")), "key").groupBy("i").agg(F.max(F.struct("w", F.length("key"), "key"))["key"].alias("key"))
    own = best.groupBy("key").agg(F.count("*").alias("own")).where(F.col("own") >= MIN_TEXTS).join(rows.select("key", "c"), "key")
    good = {s: odds(t, c, n_toxic, n_clean) for s, t, c in own.collect()}
    good = {s: w * (SURENESS if s.endswith("*") else 1) for s, w in good.items() if w >= math.log(RATIO)}
    long = [s for s in good if len(s) >= LEAST_INFLECTED and not s.endswith("*")]
    if long:  # words of clean texts that begin like an offence, and are none
        ends = F.explode(F.sequence(F.lit(1), F.lit(ENDING)))
        near = clean.select("s", ends.alias("n")).where(F.length("s") >= F.col("n") + LEAST_INFLECTED).where(F.substr("s", F.lit(1), F.length("s") - F.col("n")).isin(long))
        good = {r[0]: 0.0 for r in near.select("s").distinct().orderBy("s").limit(MOST_STEMS).collect() if r[0] not in good} | good
    return good


def odds(t: int, c: int, n_toxic: int, n_clean: int) -> float:
    """Log of how much likelier a toxic text has it, with both counts moved by 1.5 deviations to the careful side."""
    return math.log(max(0.5, t - 1.5 * math.sqrt(max(t, 0))) / (n_toxic + 1)) - math.log((c + 1 + 1.5 * math.sqrt(c + 1)) / (n_clean + 1))


def score_documents(docs: DataFrame, stems: dict[str, float]) -> DataFrame:
    """doc_id, score."""

    def run(batches):
        grammar = Grammar(stems)
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array([grammar.score(t) for t in b.column("text").to_pylist()], pa.float64())], ["doc_id", "score"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, score double")


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(4)) == 2, F.lit(False))


def training_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text and toxic of the labelled rows that may be learned from, MOST_LABELS at most: texts are not shuffled."""
    marks = labels.where("doc_id is not null and toxic is not null").where(~held_out(F.col("doc_id"))).select("doc_id", "toxic")
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(MOST_LABELS)
    return docs.select("doc_id", "text").join(F.broadcast(marks), "doc_id").select("text", "toxic")


def drop_toxic(docs: DataFrame, labels: DataFrame, all_docs: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of docs, as they are, whose text scores below the threshold; what is toxic is learned from all_docs."""
    stems = learn_stems(training_rows(all_docs, labels))
    names, schema = docs.columns, docs.schema

    def run(batches):
        grammar = Grammar(stems)
        for b in batches:
            yield b.filter(pa.array([grammar.score(t) < threshold for t in b.column(names.index("text")).to_pylist()], pa.bool_()))

    return docs.mapInArrow(run, schema)


def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = score_documents(docs, learn_stems(training_rows(docs, labels)))
    return scored.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))
