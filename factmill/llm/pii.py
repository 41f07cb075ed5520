"""Personal data replaced by keyed, type-consistent surrogates with collision checks."""

from __future__ import annotations

import hashlib
import re
import secrets
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from factmill.llm.common import BROADCAST_ROWS, free_name, is_small, map_texts, materialize, table

#: The setting that holds the secret of the surrogates; without it each application draws its own.
KEY_SETTING = "spark.factmill.surrogate.key"
_drawn: dict[str, bytes] = {}
#: Rounds of re-keying after which remaining collisions raise an error.
ROUNDS = 40

# Given and family names by script and gender; n is used where the gender is open.
GIVEN = {
    ("latin", "f"): "Alice Anna Barbara Carla Clara Diana Elena Emma Eva Greta Helen Ingrid Isabel Julia Laura Lena Lucia Maria Marta Nina Nora Olga Paula Rosa Sara Sofia Susan Teresa Vera Yvonne".split(),
    ("latin", "m"): "Adam Albert Anton Bruno Carl Daniel David Diego Erik Felix Frank George Hans Hugo Ivan Jakob James John Jorge Karl Leo Louis Luis Mark Martin Oscar Paul Peter Thomas Victor".split(),
    ("cyrillic", "f"): "Анна Вера Дарья Елена Ирина Мария Нина Ольга Софья Татьяна".split(),
    ("cyrillic", "m"): "Алексей Борис Виктор Дмитрий Иван Михаил Николай Олег Павел Сергей".split(),
    ("greek", "f"): "Άννα Ελένη Ειρήνη Μαρία Σοφία Χριστίνα".split(),
    ("greek", "m"): "Ανδρέας Γιώργος Δημήτρης Κώστας Νίκος Πέτρος".split(),
}
FAMILY = {
    "latin": "Adler Baker Becker Blanc Brandt Carter Castro Diaz Dubois Evans Fischer Fontana Garcia Girard Harris Hoffman Jensen Keller Lambert Larsen Lopez Marsh Mercier Moreno Navarro Novak Olsen Parker Petit Quinn Reyes Richter Romero Sanders Torres Vidal Wagner Walsh Weber Young".split(),
    "cyrillic": "Белов Власов Громов Егоров Зимин Козлов Лебедев Орлов Соколов Тихонов".split(),
    "greek": "Αλεξίου Βασιλείου Γεωργίου Δημητρίου Ιωάννου Νικολάου".split(),
}
TITLES = {"mr": "m", "herr": "m", "monsieur": "m", "señor": "m", "sr": "m", "don": "m", "mrs": "f", "ms": "f", "miss": "f", "frau": "f", "madame": "f", "mme": "f", "señora": "f", "sra": "f", "doña": "f", "dr": "n", "prof": "n", "г-н": "m", "г-жа": "f", "κ": "m", "κα": "f"}

_CAPITAL = "[A-ZÀ-ÖØ-ÞА-ЯΑ-ΩΆ-Ώ]"
_NAME = _CAPITAL + r"[a-zß-öø-ÿа-яёα-ωά-ώ]+"
# What each type looks like; of overlapping finds the one that begins first is taken, of those the first in this order.
PATTERNS = {
    "email": r"(?<![\w.+-])[A-Za-z0-9_.+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
    "key": r"(?<![A-Za-z0-9])(?i:AKIA)[A-Z0-9a-z]{16}(?![A-Za-z0-9])",
    "secret": r"(?i:(?:password|passwd|pwd|secret|token|api[_-]?key)[\"']?\s*[=:]\s*[\"']?)(?P<secret_value>(?=[+/_-]*[A-Za-z0-9])[A-Za-z0-9+/_-]{8,}={0,2})",
    "hex": r"(?<![A-Za-z0-9])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,64}(?![A-Za-z0-9])",
    "iban": r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])",
    "ssn": r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])",
    "card": r"(?<![\d+])[3-6]\d{3}([ -]?)\d{4}\1\d{4}\1\d{1,7}(?!\d)",
    "phone": r"(?<![\w+(])(?:\+\d{1,3}[ .-]?)?\(\d{3}\)[ .-]?\d{3}[ .-]?\d{4}(?!\d)|(?<![\w+])\+\d{1,3}(?:[ .-]?\d{2,4}){2,5}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d.-])",
    "ip": r"(?<![\d.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?![\d]|\.\d)",
    "name": rf"(?<!\w)(?P<title>(?i:{'|'.join(sorted(map(re.escape, TITLES), key=len, reverse=True))}))\.? (?P<name_value>{_NAME}(?:[ ]{_NAME})?)",
}
DETECT = re.compile("|".join(f"(?P<{k}>{v})".replace("\\1", "(?P=sep)").replace("([ -]?)", "(?P<sep>[ -]?)") for k, v in PATTERNS.items()))
HEX = re.compile(r"[0-9a-fA-F]+")
#: Letters that regular expressions without case take for those of titles and str.lower does not.
FOLD = str.maketrans("İıſϰ", "iisκ")
#: What every entity holds, for the four ways to find where one may begin: a digit or an @ in its first word, ...
_MARK, _SPACE = re.compile(r"[\d@]"), re.compile(r"\s")
#: ... the middle of AKIA, ...
_AKIA = re.compile("[Kk\u212a](?=[IiİI\u0131][Aa])")
#: ... the sign after a keyword of a secret (the lengths of all keywords), ...
_SIGN, _KEYWORDS = re.compile("[=:]"), (3, 5, 6, 7, 8)
#: ... or the space between the end of a title and a capital.
_ENDS = "".join(sorted({c for t in TITLES for c in (t[-1], t[-1].upper())} | set("İıſϰ")))
_TITLED, _LENGTHS = re.compile(f" (?<=[{_ENDS}.] )(?={_CAPITAL})"), sorted({len(t) for t in TITLES})


def surrogate_key(spark: SparkSession) -> bytes:
    """The secret in KEY_SETTING (at most 64 bytes count), else one drawn for this application, which nobody can use again."""
    named = spark.conf.get(KEY_SETTING, None)
    if named:
        return named.encode()[:64]
    return _drawn.setdefault(spark.sparkContext.applicationId, secrets.token_bytes(32))


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def script_of(name: str) -> str:
    first = next((c for c in name if c.isalpha()), "a")
    return "cyrillic" if "Ѐ" <= first <= "ӿ" else "greek" if "Ͱ" <= first <= "Ͽ" else "latin"


def _gender(title: str) -> str | None:
    return TITLES.get(title.translate(FOLD).lower())


def _starts(text: str) -> list[int]:
    """All places where an entity may begin, in order."""
    out, end = set(), 0
    for m in _MARK.finditer(text):
        at = m.start()
        if at < end:
            continue
        gap = _SPACE.search(text, at)
        start, end = at, gap.start() if gap else len(text)
        while start > 0 and not text[start - 1].isspace():
            start -= 1
        out.update(range(start, end))
    out.update(m.start() - 1 for m in _AKIA.finditer(text))
    for m in _SIGN.finditer(text):
        at = m.start()
        while at > 0 and text[at - 1].isspace():
            at -= 1
        at -= at > 0 and text[at - 1] in "\"'"
        out.update(at - n for n in _KEYWORDS)
    for m in _TITLED.finditer(text):
        at = m.start()
        at -= text[at - 1] == "."
        out.update(at - n for n in _LENGTHS if at >= n and _gender(text[at - n : at]))
    return sorted(s for s in out if s >= 0)


def _matches(text: str) -> Iterator[re.Match]:
    """The same matches as ``DETECT.finditer(text)``, tried only where one may begin."""
    end = 0
    for start in _starts(text):
        if start >= end and (m := DETECT.match(text, start)):
            end = m.end()
            yield m


def find(text: str) -> list[tuple[int, int, str, str, str]]:
    """(start, end, type, surface, canonical form) of the entities of a text, in order and without overlap."""
    out = []
    for m in _matches(text):
        kind = m.lastgroup if m.lastgroup in PATTERNS else next(k for k in PATTERNS if m[k] is not None)
        a, b = m.span({"secret": "secret_value", "name": "name_value"}.get(kind, kind))
        value = text[a:b]
        canonical = value
        if kind == "secret" and HEX.fullmatch(value):
            kind = "hex"
        if kind in ("email", "key", "hex"):
            canonical = value.lower()
        elif kind in ("phone", "card", "ssn"):
            canonical = "".join(c for c in value if c.isdigit())
            if kind == "card" and not (13 <= len(canonical) <= 19 and luhn(canonical)):  # any other long number
                continue
        elif kind == "iban":
            canonical = value.replace(" ", "")
        elif kind == "name":
            canonical = f"{_gender(m['title'])}:{value}"
        out.append((a, b, kind, value, canonical))
    return out


def _name_parts(canonical: str, given_words: frozenset[str] | set[str]) -> list[tuple[str, str]]:
    """(kind, canonical form) of a name's words: given names by gender, surnames by stem, whatever the title was."""
    gender, _, value = canonical.partition(":")
    *first, last = value.split(" ")
    if not first and last in given_words:
        first, last = [last], None
    parts = [("given", f"{gender if gender != 'n' else _guess(w)}:{w}") for w in first]
    if last:
        parts.append(("family", last[:-1] if script_of(last) == "cyrillic" and last.endswith("а") and len(last) > 3 else last))
    return parts


def _guess(given: str) -> str:
    """Gender of a given name after a title for both."""
    for (_, gender), names in GIVEN.items():
        if given in names:
            return gender
    return "f" if given[-1] in "aаяαηάή" else "m"


def _keyed(found: list) -> list[list[tuple[str, str]]]:
    """For each find of a text, what its surrogate is drawn for: itself or, of a name, its parts.

    A single word after a title is a given name if the text has it before a surname, else a surname.
    """
    names = [c.partition(":")[2].split(" ") for _, _, k, _, c in found if k == "name"]
    given, families = {n[0] for n in names if len(n) > 1}, {n[-1] for n in names if len(n) > 1}
    return [_name_parts(c, given - families) if k == "name" else [(k, c)] for _, _, k, _, c in found]


class _Stream:
    """Numbers drawn from a keyed hash of (type, canonical form, attempt): the same for the same entity everywhere."""

    def __init__(self, key: bytes, kind: str, canonical: str, attempt: int) -> None:
        self.seed = f"{kind}\0{canonical}\0{attempt}".encode()
        self.key, self.n, self.pool = key, 0, b""

    def below(self, n: int) -> int:
        if len(self.pool) < 4:
            self.pool += hashlib.blake2b(self.seed + self.n.to_bytes(4, "big"), key=self.key, digest_size=64).digest()
            self.n += 1
        value, self.pool = int.from_bytes(self.pool[:4], "big"), self.pool[4:]
        return value * n >> 32


def _like(c: str, draw: _Stream) -> str:
    """A character of the same class."""
    if c.isdigit() and c.isascii():
        return "0123456789"[draw.below(10)]
    if "a" <= c <= "z":
        return "abcdefghijklmnopqrstuvwxyz"[draw.below(26)]
    if "A" <= c <= "Z":
        return "ABCDEFGHIJKLMNOPQRSTUVWXYZ"[draw.below(26)]
    return c


def surrogate(kind: str, canonical: str, attempt: int = 0, *, key: bytes) -> str:
    """The canonical form of the entity's surrogate: valid for its type, never the entity itself."""
    while True:
        draw = _Stream(key, kind, canonical, attempt)
        if kind == "phone":
            keep = len(canonical) - 10 if len(canonical) > 10 else 0  # the country's digits stay
            new = canonical[:keep] + "".join("23456789"[draw.below(8)] if i == 0 else _like(c, draw) for i, c in enumerate(canonical[keep:]))
            if canonical[keep + 3 : keep + 6] == "555":
                new = new[: keep + 3] + "555" + new[keep + 6 :]
        elif kind == "card":
            body = canonical[0] + "".join(_like(c, draw) for c in canonical[1:-1])
            ends = [d for d in "0123456789" if luhn(body + d) == luhn(canonical)]
            new = body + ends[draw.below(len(ends))]
        elif kind == "ip":
            parts = canonical.split(".")
            wide = attempt % 1000
            fixed = 1 if parts[0] in ("10", "127") else 2 if (parts[0], parts[1]) in (("192", "168"), ("169", "254")) else 0
            if fixed and wide >= 8:  # narrow ranges overflow into 10.x.y.z, that into all
                parts, fixed = ["10"], int(wide < 20)
            new = ".".join(parts[:fixed] + [str(1 + draw.below(223 if i == 0 and not fixed else 254)) for i in range(4 - fixed)])
            if not fixed and new.split(".")[0] in ("10", "127", "192", "169", "172"):
                attempt += 1000
                continue
        elif kind == "email":
            local, _, domain = canonical.partition("@")
            labels = domain.split(".")
            site = _Stream(key, "domain", domain, 0)  # one surrogate domain for each domain
            local += "a" * (attempt % 1000 // 4)  # longer where short ones run out
            new = "".join(_like(c, draw) for c in local) + "@" + ".".join(["".join(_like(c, site) for c in x) if i == 0 and len(labels) > 1 else x for i, x in enumerate(labels)])
        elif kind == "key":
            new = canonical[:4] + "".join("abcdefghijklmnopqrstuvwxyz234567"[draw.below(32)] for _ in canonical[4:])
        elif kind == "hex":
            new = "".join("0123456789abcdef"[draw.below(16)] for _ in canonical)
        elif kind == "iban":
            body = "".join(_like(c, draw) for c in canonical[4:])
            number = "".join(str(int(c, 36)) for c in body + canonical[:2] + "00")
            new = f"{canonical[:2]}{98 - int(number) % 97:02d}{body}"
        elif kind == "ssn":
            new = f"{1 + draw.below(665):03d}{1 + draw.below(99):02d}{1 + draw.below(9999):04d}"
        elif kind in ("given", "family"):  # the pool grows with the attempts and has no bound
            gender, _, value = canonical.rpartition(":")
            names = GIVEN[script_of(value), gender] if kind == "given" else FAMILY[script_of(value)]
            more = [names[draw.below(len(names))] for _ in range(1 + attempt % 1000 // 2)]
            new = more[0] + "".join(more[1:]).lower()
            if kind == "given":
                new = f"{gender}:{new}"
        else:  # signs give way where letters and digits alone don't make enough different secrets
            new = "".join("abcdefghijklmnopqrstuvwxyz"[draw.below(26)] if attempt >= 8 and not c.isalnum() and c != "=" else _like(c, draw) for c in canonical)
        if new != canonical:
            return new
        attempt += 1000


def _dress(kind: str, surface: str, new: str) -> str:
    """The surrogate in the surface's format: its separators, grouping and case."""
    if kind in ("phone", "card", "ssn", "iban"):
        digits = iter(new)
        return "".join(next(digits) if c.isalnum() else c for c in surface)
    if kind in ("email", "key", "hex"):
        letters = [c for c in surface if c.isalpha()]
        if letters and all(c.isupper() for c in letters):
            return new.upper()
    return new


def _draw(kind: str, surface: str, canonical: str, parts: list[tuple[str, str]], attempts: dict[tuple[str, str], int], key: bytes) -> str:
    drawn = [surrogate(k, c, attempts.get((k, c), 0), key=key) for k, c in parts]
    if kind != "name":
        return _dress(kind, surface, drawn[0])
    words = [d.rpartition(":")[2] for d in drawn]
    last = surface.split(" ")[-1]
    if parts[-1][0] == "family" and script_of(last) == "cyrillic" and (canonical[0] == "f" or last != parts[-1][1]):
        words[-1] += "а"
    return " ".join(words)


def replace(text: str, attempts: dict[tuple[str, str], int], key: bytes) -> tuple[str, int, int]:
    """The text with surrogates, how many entities it had and how many different ones."""
    out, at, seen = [], 0, set()
    found = find(text)
    for (a, b, kind, surface, canonical), parts in zip(found, _keyed(found), strict=True):
        seen.add((kind, canonical))
        out += [text[at:a], _draw(kind, surface, canonical, parts, attempts, key)]
        at = b
    return ("".join([*out, text[at:]]) if out else text), len(found), len(seen)


def _entities(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        rows = sorted({part for t in batch["text"] for parts in _keyed(find(t)) for part in parts})
        yield pd.DataFrame(rows, columns=["kind", "canonical"])


def _surrogates(key: bytes):
    @F.pandas_udf("string")
    def draw(kind: pd.Series, canonical: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, c, int(a), key=key) for k, c, a in zip(kind, canonical, attempt, strict=True)], dtype=object)

    return draw


def collisions(entities: DataFrame, key: bytes) -> DataFrame:
    """(kind, canonical, attempt) of the entities whose first surrogate is another entity or another's surrogate.

    ``entities``: distinct (kind, canonical). All draw a surrogate; of those that share one the least keeps it, and
    none may draw what occurs in the data; the others draw again, against all drawn so far, until all differ.
    """
    draw = _surrogates(key)
    entities = materialize(entities, "entities")
    taken = entities.select(F.col("kind").alias("k"), F.col("canonical").alias("s"))
    waiting, fixed = entities.withColumn("attempt", F.lit(0)), None
    for _ in range(ROUNDS):
        drawn = materialize(waiting.withColumn("s", draw("kind", "canonical", "attempt")), "drawn")
        used = taken if fixed is None else taken.union(fixed.select("kind", "s"))
        clash = drawn.join(used.distinct().withColumn("used", F.lit(True)), (F.col("kind") == F.col("k")) & (drawn["s"] == used["s"]), "left")
        clash = clash.select("kind", "canonical", "attempt", drawn["s"].alias("s"), "used")
        first = F.row_number().over(W.partitionBy("kind", "s").orderBy("canonical"))
        judged = materialize(clash.withColumn("ok", F.col("used").isNull() & (first == 1)), "judged")
        good = judged.where("ok").select("kind", "canonical", "attempt", "s")
        fixed = good if fixed is None else fixed.union(good)
        waiting = judged.where("not ok").select("kind", "canonical", (F.col("attempt") + 1).alias("attempt"))
        if waiting.isEmpty():
            return fixed.where("attempt > 0").select("kind", "canonical", "attempt")
    raise RuntimeError(f"surrogates still collide after {ROUNDS} rounds")


def _replacer(attempts: dict, key: bytes):
    def run(texts: list[str]) -> tuple:
        rows = [replace(t, attempts, key) for t in texts]
        return None, [[r[0] for r in rows], [r[1] for r in rows], [r[2] for r in rows]]

    return run


def _replacer_by_row(key: bytes):
    @F.pandas_udf("struct<new_text:string,n_entities:bigint,n_distinct:bigint>")
    def run(texts: pd.Series, attempts: pd.Series) -> pd.DataFrame:
        own = [{(a["kind"], a["canonical"]): a["attempt"] for a in (x if x is not None else [])} for x in attempts]
        return pd.DataFrame([replace(t, a, key) for t, a in zip(texts, own, strict=True)], columns=["new_text", "n_entities", "n_distinct"])

    return run


def _with_own_attempts(rows: DataFrame, redrawn: DataFrame, name: str) -> DataFrame:
    """Adds to each row, as ``name``, the attempts of its own entities, by shuffles; for more collisions than may be broadcast."""

    def per_text(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            found = [(h, k, c) for h, t in zip(batch["th"], batch["text"], strict=True) for k, c in {part for parts in _keyed(find(t)) for part in parts}]
            yield pd.DataFrame(found, columns=["th", "kind", "canonical"])

    texts = rows.select(F.xxhash64("text").alias("th"), "text")
    own = texts.mapInPandas(per_text, "th long, kind string, canonical string").distinct()
    listed = F.collect_list(F.struct("kind", "canonical", "attempt"))
    own = own.join(redrawn, ["kind", "canonical"]).groupBy(F.col("th").alias(f"{name}_of")).agg(listed.alias(name))
    return rows.join(own, F.xxhash64(rows["text"]) == own[f"{name}_of"], "left").drop(f"{name}_of")


def pseudonymize(documents: DataFrame, key: bytes, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All columns of ``documents``, ``text`` with surrogates, plus n_entities and n_distinct (columns of that name are replaced).

    ``key``: the secret, at most 64 bytes. The same entity gets the same surrogate in every document and format, different ones never share one, and no
    surrogate is an entity of the data: surrogates are keyed hashes shaped like their type, and a check over all
    entities re-keys those that collide. The few re-keyed ones are sent to all tasks if they are few, else joined.

    Null texts stay null with 0 entities; empty ones stay empty; repeated rows keep a row each; other columns are
    kept as they are; an empty table gives an empty result.
    """
    counts = {"n_entities", "n_distinct"}
    rest = [c for c in documents.columns if c.lower() not in counts | {"text"}]
    absent, new, own, inner = (free_name(documents, n) for n in ("absent", "new_text", "attempts", "replaced"))
    rows = documents.select(*rest, F.col("text").isNull().alias(absent), F.coalesce("text", F.lit("")).alias("text"))
    entities = rows.select("text").mapInPandas(_entities, "kind string, canonical string").distinct()
    redrawn = materialize(collisions(entities, key), "redrawn")
    few = is_small(redrawn, broadcast_rows)
    attempts = {(r["kind"], r["canonical"]): r["attempt"] for r in redrawn.toLocalIterator()} if few else {}
    if few:
        out = map_texts(rows, _replacer(attempts, key), [(new, "string"), ("n_entities", "long"), ("n_distinct", "long")])
    else:
        out = _with_own_attempts(rows, redrawn, own).withColumn(inner, _replacer_by_row(key)("text", own))
        out = out.select(*rest, absent, F.col(inner)["new_text"].alias(new), F.col(inner)["n_entities"].alias("n_entities"), F.col(inner)["n_distinct"].alias("n_distinct"))
    text = F.when(~F.col(absent), F.col(new)).alias("text")
    return out.select(*[text if c.lower() == "text" else c for c in documents.columns if c.lower() not in counts], "n_entities", "n_distinct")


def op6_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pseudonymize(table(spark, sf_dir, "documents").select("doc_id", "text"), surrogate_key(spark))
