"""Toxicity by a weighted finite-state pattern grammar over clauses."""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from factmill.llm.common import id_remainder, map_texts, materialize, table

#: Labelled documents (least hash of doc_id first) from which the lexicon and the arcs' weights are learned.
SAMPLE = 20_000
#: Lexicon candidates that are weighed against each other, and the most entries that are kept.
CANDIDATES = 8_000
ENTRIES = 2_000
#: Documents that an entry must explain beyond others; chance (e to the minus this) that any entry is taken for an insult.
LEAST = 3
DOUBT = 7.0
THRESHOLD = 0.7
#: Least log odds of a whole word (=) and of a stem (^): there are far more stems, so chance finds stronger ones.
LEAST_ODDS = {"=": 2.3, "^": 4.0}

# Closed word classes of the grammar in English, German, French and Spanish.
THREATS = (
    "kill kills killed killing hurt hurts hurting shoot shoots shot shooting stab stabs stabbed stabbing beat beats beaten beating burn burns burned burning destroy destroys destroyed destroying"
    " töten töte tötet getötet schlagen schlage schlägt erschießen erschieße erschossen verletzen verletze verletzt tuer tue tué tuerai tuerons frapper frappe frappé blesser blesse blessé brûler brûle brûlé"
    " matar mato mataré matado golpear golpeo golpearé herir hiero heriré quemar quemo quemaré"
).split()
TARGETS = "you your yours he him she her they them du dich dir ihr euch sie tu toi te vous ils elles tú ti usted ustedes ellos ellas".split()
NEGATIONS = "not never no nor without nicht kein keine nie ohne pas jamais aucun sans nunca jamás sin ningún".split()
REPORTS = "said says told wrote called quoted claimed sagte sagt schrieb nannte dit disait écrit dijo dice escribió llamó".split()
# Prior chance that a clause is toxic in which an insult stands alone or under one more tag, or a threat with
# its target, and how many labelled documents it counts for.
PRIORS = {"insult": 0.85, "target": 0.95, "negated": 0.35, "reported": 0.35, "aimed": 0.6}
PRIOR_DOCUMENTS = 4.0
#: What further clauses add to the strongest one, each.
FURTHER = 0.25

WORD = re.compile(r"[^\W\d_]+")
CLAUSE_END = re.compile(r"[.!?;:\n]")
#: Shortest and longest stems that stand for the words which begin with them.
STEM = (4, 8)


@dataclass(frozen=True)
class Transducer:
    """A small weighted machine: (state, symbol) -> (state, tag or None); a missing arc keeps the state silently.

    An arc weighs what its tag does; a tag counts once for a clause.
    """

    arcs: dict[tuple[str, str], tuple[str, str | None]]
    start: str = "0"

    def step(self, state: str, symbol: str) -> tuple[str, str | None]:
        return self.arcs.get((state, symbol), (state, None))


@dataclass
class Composition:
    """Machines that read one tape of word classes side by side; joint states are made as they are reached.

    A joint arc carries the tags of its parts. A clause's weight is the sum of the weights of its tags' arcs.
    """

    machines: list[Transducer]
    weights: dict[str, float] = field(default_factory=dict)
    steps: dict = field(default_factory=dict)

    def tags(self, symbols: Iterable[str]) -> frozenset[str]:
        """The tags that a clause gives off."""
        state, tags = tuple(m.start for m in self.machines), set()
        for symbol in symbols:
            key = (state, symbol)
            if key not in self.steps:
                moved = [m.step(s, symbol) for m, s in zip(self.machines, state, strict=True)]
                self.steps[key] = (tuple(s for s, _ in moved), tuple(t for _, t in moved if t))
            state, out = self.steps[key]
            tags.update(out)
        return frozenset(tags)

    def weigh(self, tags: frozenset[str]) -> float:
        return sum(self.weights.get(t, 0.0) for t in tags)


def grammar(weights: dict[str, float] | None = None) -> Composition:
    """Insult, threat, target, negation and reported-speech machines over the classes I T Y N R and w (other words)."""
    insult = Transducer({("0", "I"): ("0", "insult")})
    threat = Transducer({("0", "T"): ("t", None), ("t", "Y"): ("t", "aimed"), ("0", "Y"): ("y", None), ("y", "T"): ("t", "aimed")})
    target = Transducer({("0", "Y"): ("y", None), ("y", "I"): ("y", "target"), ("0", "I"): ("i", None), ("i", "Y"): ("y", "target")})
    # a negation reaches the next two words
    negation = Transducer({("0", "N"): ("2", None), ("1", "N"): ("2", None), ("2", "w"): ("1", None), ("2", "Y"): ("1", None), ("1", "w"): ("0", None), ("1", "Y"): ("0", None), ("2", "I"): ("0", "negated"), ("1", "I"): ("0", "negated"), ("2", "T"): ("0", "negated"), ("1", "T"): ("0", "negated")})
    reported = Transducer({("0", "R"): ("r", None), ("r", "I"): ("r", "reported"), ("r", "T"): ("r", "reported")})
    return Composition([insult, threat, target, negation, reported], weights or {})


def matches(tags: frozenset[str]) -> bool:
    """Whether a clause's tags amount to anything: an insult, or a threat at somebody that is neither negated nor reported."""
    return "insult" in tags or "aimed" in tags and not tags & {"negated", "reported"}


CLASSES = {w: c for c, words in (("R", REPORTS), ("N", NEGATIONS), ("Y", TARGETS), ("T", THREATS)) for w in words}


@dataclass
class Lexicon:
    """Insults: whole words and stems with their log odds."""

    words: dict[str, float]
    stems: dict[str, float]

    arcs: dict[str, float] = field(default_factory=dict)

    def __post_init__(self) -> None:
        self.lengths = sorted({len(s) for s in self.stems}, reverse=True)
        parts = [re.escape(s) for s in sorted(self.stems)] + [rf"{re.escape(w)}(?![^\W\d_])" for w in sorted(self.words)] + [rf"{re.escape(w)}(?![^\W\d_])" for w in THREATS]
        self.trigger = re.compile(rf"(?<![^\W\d_])(?:{'|'.join(parts)})")
        self.composition = grammar(self.arcs)

    def weight(self, word: str) -> float | None:
        found = self.words.get(word)
        for n in self.lengths:
            if len(word) > n and word[:n] in self.stems:
                found = max(found or -math.inf, self.stems[word[:n]])
        return found

    def clauses(self, text: str) -> list[tuple[frozenset[str], float]]:
        """(tags, greatest weight of an insult) of every clause in which a trigger stands and that amounts to anything."""
        text = text.lower()
        out, done = [], 0
        while m := self.trigger.search(text, done):
            start = max(done, *(text.rfind(c, done, m.start()) + 1 for c in ".!?;:\n"))  # not before the last clause's end
            stop = CLAUSE_END.search(text, m.end())
            done = stop.end() if stop else len(text)
            symbols, best = [], -math.inf
            for word in WORD.findall(text, start, done):
                w = self.weight(word)
                symbols.append("I" if w is not None else CLASSES.get(word, "w"))
                best = max(best, w if w is not None else best)
            tags = self.composition.tags(symbols)
            if matches(tags):
                out.append((tags, best if best > -math.inf else 0.0))
        return out


def _entries(text: str) -> set[str]:
    words = set(WORD.findall(text.lower()))
    low, high = STEM
    return {f"={w}" for w in words if len(w) > 2} | {f"^{w[:n]}" for w in words for n in range(low, min(high, len(w) - 1) + 1)}


def _count_entries(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        counts = (Counter(), Counter())
        for text, toxic in zip(batch["text"], batch["toxic"], strict=True):
            counts[toxic].update(_entries(text))
        keys = list(counts[1].keys() | counts[0].keys())
        yield pd.DataFrame({"entry": keys, "n0": [counts[0][k] for k in keys], "n1": [counts[1][k] for k in keys]})


def _which(candidates: list[str]):
    wanted = set(candidates)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"found": [sorted(_entries(t) & wanted) for t in batch["text"]]})

    return run


def _cover(rows: list[list[str]], odds: dict[str, float]) -> list[str]:
    """Entries that explain the toxic documents: the one that explains most of what is left, then the longer, until few are left."""
    holds: dict[str, set[int]] = {}
    for i, row in enumerate(rows):
        for e in row:
            holds.setdefault(e, set()).add(i)
    left, chosen = set(range(len(rows))), []

    def rank(e: str, explained: int) -> tuple:
        return (-explained, -odds[e], e[0] != "=", -len(e), e)

    queue = [(rank(e, len(own)), e) for e, own in holds.items()]
    heapq.heapify(queue)
    while queue and left and len(chosen) < ENTRIES:
        _, best = heapq.heappop(queue)
        explained = len(holds[best] & left)
        if explained < LEAST:
            continue
        now = rank(best, explained)
        if queue and now > queue[0][0]:  # it explains less than when it was queued
            heapq.heappush(queue, (now, best))
            continue
        chosen.append(best)
        left -= holds.pop(best)
    # synonyms of chosen words often stand beside them, so nothing is left for them to explain
    sizes = sorted(sum(e in row for row in rows) for e in chosen if e[0] == "=")
    usual = sizes[len(sizes) // 2] if sizes else math.inf
    more = [e for e in sorted(holds) if e[0] == "=" and len(holds[e]) >= 0.5 * usual]
    return chosen + more[: ENTRIES - len(chosen)]


@dataclass
class Model:
    lexicon: Lexicon
    none: float

    def score(self, text: str) -> float:
        """The chance from the strongest clause and, each by FURTHER, all others that speak for it."""
        clauses = self.lexicon.clauses(text)
        if not clauses:
            return self.none
        each = [w + self.lexicon.composition.weigh(tags) for tags, w in clauses]
        best = max(each)
        total = best + FURTHER * (sum(max(0.0, x) for x in each) - max(0.0, best))
        return 1.0 / (1.0 + math.exp(-max(-20.0, min(20.0, total))))


def _kinds(lexicon: Lexicon):
    """For each text, once each, the tags that single out an arc: those of clauses with an insult and at most one more tag, or a threat."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for t, y in zip(batch["text"], batch["toxic"], strict=True):
                found = {tags - {"aimed"} if "insult" in tags else tags for tags, _ in lexicon.clauses(t)}
                kinds = {next(iter(tags - {"insult"}), "insult") for tags in found if len(tags) <= 2} if found else {"none"}
                rows += [(k, int(y)) for k in kinds]
            yield pd.DataFrame(rows, columns=["kind", "toxic"])

    return run


def fit(documents: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Learns the insults and the weights of the grammar's patterns from at most ``sample`` labelled rows.

    Rows with crc32(doc_id as text) mod 3 = 1 are never used. Of repeated texts one is used. Only counts of bounded
    size and the candidates found in sampled toxic rows reach the driver; no text does.
    """
    known = labels.where((id_remainder(F.col("doc_id"), 3) != 1) & F.col("toxic").isNotNull() & F.col("doc_id").isNotNull())
    known = known.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)
    # bounded by `sample`
    rows = documents.select("doc_id", "text").join(F.broadcast(known.withColumnRenamed("doc_id", "_id")), F.col("doc_id") == F.col("_id")).where("text is not null")
    rows = materialize(rows.select("text", "toxic").dropDuplicates(["text"]), "labelled")
    size = {r["toxic"]: r["n"] for r in rows.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n0, n1 = size.get(0, 0), size.get(1, 0)
    counts = rows.mapInPandas(_count_entries, "entry string, n0 long, n1 long").groupBy("entry").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    # evidence against chance: n1 * ln(n1 / expected) + n0 * ln(n0 / expected) must pass a bound that grows with the entries only
    share, n, seen = max(1, n1) / max(1, n0 + n1), F.col("n0") + F.col("n1"), F.col("n0").cast("double")
    evidence = F.col("n1") * F.ln(F.col("n1") / (n * share)) + F.when(seen > 0, seen * F.ln(seen / (n * max(1e-9, 1 - share)))).otherwise(0.0)
    counts = materialize(counts, "entries")
    bound = math.log(max(1, counts.count())) + DOUBT
    good = counts.where((F.col("n1") >= LEAST) & (F.col("n1") * max(n0, 1) >= F.col("n0") * 20 * max(n1, 1)) & (evidence >= bound))
    found = good.orderBy(F.desc("n1"), "entry").limit(CANDIDATES).collect()
    odds = {r["entry"]: math.log((r["n1"] + 0.5) / (r["n0"] + 0.5)) for r in found}
    odds = {e: o for e, o in odds.items() if o >= LEAST_ODDS[e[0]]}
    toxic = rows.where("toxic = 1").mapInPandas(_which(list(odds)), "found array<string>")
    chosen = _cover([r["found"] for r in toxic.toLocalIterator()], odds) if odds else []
    lexicon = Lexicon({e[1:]: odds[e] for e in chosen if e[0] == "="}, {e[1:]: odds[e] for e in chosen if e[0] == "^"})
    seen = {(r["kind"], r["toxic"]): r["n"] for r in rows.mapInPandas(_kinds(lexicon), "kind string, toxic int").groupBy("kind", "toxic").agg(F.count(F.lit(1)).alias("n")).collect()}

    def chance(kind: str, prior: float) -> float:
        a, b = seen.get((kind, 1), 0), seen.get((kind, 0), 0)
        return (a + PRIOR_DOCUMENTS * prior) / (a + b + PRIOR_DOCUMENTS)

    logit = {k: math.log(c / (1 - c)) for k, prior in PRIORS.items() if 0 < (c := chance(k, prior)) < 1}
    arcs = {k: max(-8.0, min(2.0, x - (0.0 if k == "aimed" else logit["insult"]))) for k, x in logit.items() if k != "insult"}
    return Model(Lexicon(lexicon.words, lexicon.stems, arcs), min(0.4, chance("none", n1 / max(1, n0 + n1))))


def _scorer(model: Model):
    return lambda texts: (None, [[model.score(t) for t in texts]])


def score_documents(documents: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted for every row; the whole text is read, nothing but the text is scored.

    Null and empty texts match no clause and get the chance of unmatched texts; null ids count as not held out by
    their remainder (crc32 of the empty text); repeated rows keep a row each; an empty table gives an empty result.
    """
    rows = map_texts(documents.select("doc_id", "text"), _scorer(model), [("score", "double")])
    return rows.select("doc_id", (id_remainder(F.col("doc_id"), 3) == 1).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"))


def keep_clean(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``documents``, all columns, whose text the fitted grammar does not reject."""
    judge = _judge(fit(documents, labels))
    return documents.where(~judge(F.coalesce("text", F.lit(""))))


def _judge(model: Model):
    @F.pandas_udf("boolean")
    def toxic(texts: pd.Series) -> pd.Series:
        return pd.Series([model.score(t) >= THRESHOLD for t in texts], dtype=bool)

    return toxic


def op2_toxicity_grammar(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return score_documents(documents, fit(documents, table(spark, sf_dir, "labels")))
