"""MinHash near-duplicates by min-max hashing (operator 3).

1. ``sketch`` (where the texts lie): each text's set of distinct shingles, a checksum of the
   set (its *class*: exact copies are one class from here on), and for every permutation both
   the minimum and the maximum of the permuted shingles: two signature values for one hash.
   ``ROWS`` values make a band; a pair of similarity 0.75 misses all bands with probability
   (1 - 0.75**ROWS)**BANDS, about 2 in a million.
2. Candidates: classes that share a band. A band's classes are not paired with each other but
   each with the band's lead (a star), so a band of m classes gives m - 1 pairs, however large.
   The lead is the class that meets most others in all its bands: of a group of edited copies,
   the text they were made from.
3. ``confirm``: both full sets, intersected exactly.
4. ``components`` of the confirmed links, by spreading minima and jumping along them.
5. ``again``: bands that still hold several components get new leads, drawn by a hash of band
   and round, so a class meets as many leads as it has bands; only pairs across components are
   confirmed. Rounds go on until one adds no link. Pairs stay below bands times classes.
6. ``residual``: what rounds of stars can have missed, exactly. For the classes of bands that
   are still mixed, a prefix join: two sets of similarity 0.75 must share one of their rarest
   shingles (a quarter of each set, and one), early enough in both that what follows can still
   suffice, and their parity bitmaps must not differ in more bits than the sets may. Per
   shingle, only classes outside its commonest component are paired with the others.

Texts move once (those of classes with candidates are picked from the documents); links,
components and checksums stay distributed.

Defined cases: null and word-less texts have no shingles and are linked with nothing; with
fewer words than a shingle has, the whole sequence is the one shingle; repeated rows are one
class; ties in doc_id share their component; a null doc_id is no component's smallest unless
there is no other; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from waferline.llm.common import SPACED, WORD, fresh, split_words, starts_of, stored

WORDS = 5
#: Links have 100 * intersection >= PERCENT * union.
PERCENT = 75
BANDS, ROWS = 48, 5
PERMUTATIONS = BANDS * ROWS // 2

_RNG = np.random.default_rng(75)
_FLIP = _RNG.integers(0, 1 << 32, PERMUTATIONS, dtype=np.uint64).astype(np.uint32)[:, None]
_ODD = (_RNG.integers(0, 1 << 31, PERMUTATIONS, dtype=np.uint64) * 2 + 1).astype(np.uint32)[:, None]
#: Signature values of each band, minima and maxima mixed.
_LAYOUT = _RNG.permutation(2 * PERMUTATIONS).reshape(BANDS, ROWS)
_MIX = _RNG.integers(0, 1 << 63, WORDS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)

#: Bits of a class's parity bitmap, in words of 64.
BITMAP = 8

SKETCH = "doc_id long, mark long, n_shingles long, cls long, bands array<long>"


def shingles(texts, size: int = WORDS) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes (64 bits) of each text."""
    words, counts = split_words(texts, SPACED)
    coded = words.dictionary_encode()
    vocabulary = coded.dictionary.to_pylist()
    h = np.array([xxhash.xxh3_64_intdigest(w) for w in vocabulary], np.uint64)[coded.indices.to_numpy()] \
        if len(words) else np.zeros(0, np.uint64)
    n = max(0, len(h) - size + 1)
    s = np.zeros(n, np.uint64)
    for k in range(size):
        s = (s ^ (s >> np.uint64(29))) * _MIX[k % WORDS] + h[k:k + n]
    s = (s ^ (s >> np.uint64(32))) * _MIX[0]
    s ^= s >> np.uint64(29)
    starts = starts_of(counts)
    for k, c in enumerate(counts.tolist()):
        if c >= size:
            yield np.unique(s[starts[k]:starts[k] + c - size + 1])
        elif c:
            yield np.array([xxhash.xxh3_64_intdigest(h[starts[k]:starts[k] + c].tobytes())], np.uint64)
        else:
            yield np.zeros(0, np.uint64)


def class_of(s: np.ndarray) -> int:
    return int(np.int64(np.uint64(xxhash.xxh3_64_intdigest(s.tobytes())).view(np.int64)))


def band_keys(s: np.ndarray) -> np.ndarray:
    """One 64-bit key per band of a non-empty shingle set."""
    x = (s >> np.uint64(32)).astype(np.uint32)
    low = np.full(PERMUTATIONS, 0xFFFFFFFF, np.uint32)
    high = np.zeros(PERMUTATIONS, np.uint32)
    for at in range(0, len(x), 4096):
        p = (x[None, at:at + 4096] ^ _FLIP) * _ODD
        np.minimum(low, p.min(axis=1), out=low)
        np.maximum(high, p.max(axis=1), out=high)
    signature = np.concatenate([low, high])[_LAYOUT].astype(np.uint64)
    key = np.arange(1, BANDS + 1, dtype=np.uint64) * _MIX[1]
    for k in range(ROWS):
        key = (key ^ (key >> np.uint64(31))) * _MIX[2] + signature[:, k]
    key = (key ^ (key >> np.uint64(31))) * _MIX[3]
    return (key ^ (key >> np.uint64(33))).view(np.int64)


def text_mark() -> Column:
    """With doc_id, the key of a row: rows of a null or repeated id are told apart by it."""
    return F.xxhash64(F.col("text").cast("string"))


def sketch(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """Store doc_id, mark (checksum of the text), n_shingles, class and band keys of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for at in range(0, b.num_rows, 512):
                piece = b.slice(at, 512)
                n, cls, bands = [], [], []
                for s in shingles(piece.column(2).to_pylist(), size):
                    n.append(len(s))
                    cls.append(class_of(s) if len(s) else None)
                    bands.append(band_keys(s) if len(s) else np.zeros(0, np.int64))
                yield pa.RecordBatch.from_arrays(
                    [piece.column(0), piece.column(1), pa.array(n, pa.int64()), pa.array(cls, pa.int64()),
                     pa.ListArray.from_arrays(pa.array(starts_of([len(x) for x in bands]), pa.int32()),
                                              pa.array(np.concatenate(bands), pa.int64()))],
                    ["doc_id", "mark", "n_shingles", "cls", "bands"])

    return stored(docs.select(F.col("doc_id").cast("long"), text_mark().alias("mark"), F.col("text").cast("string"))
                  .mapInArrow(run, SKETCH), "sketch")


def alike_in_size(a: Column, b: Column) -> Column:
    """Sets of these sizes can reach the similarity."""
    return F.least(a, b) * 100 >= F.greatest(a, b) * PERCENT


def confirm(pairs: DataFrame, sets: DataFrame, size: int = WORDS) -> DataFrame:
    """The pairs (a, b) whose full sets reach the similarity. ``sets``: cls, packed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        text = lambda x: unpack.decompress(x).decode("utf-8", "surrogatepass")
        for b in batches:
            ok = np.zeros(b.num_rows, bool)
            for at in range(0, b.num_rows, 256):
                both = [text(b.column(c)[i].as_py()) for i in range(at, min(at + 256, b.num_rows)) for c in (2, 3)]
                sets = list(shingles(both, size))
                for k in range(0, len(sets), 2):
                    x, y = sets[k], sets[k + 1]
                    common = len(np.intersect1d(x, y, assume_unique=True))
                    ok[at + k // 2] = 100 * common >= PERCENT * (len(x) + len(y) - common)
            keep = pa.array(ok)
            yield pa.RecordBatch.from_arrays([b.column(0).filter(keep), b.column(1).filter(keep)], ["a", "b"])

    left = sets.select(F.col("cls").alias("a"), F.col("packed").alias("pa"))
    right = sets.select(F.col("cls").alias("b"), F.col("packed").alias("pb"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "pa", "pb").mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """cls, label: the smallest class that links (a, b) lead to, for every linked class."""
    both = stored(links.select("a", "b").union(links.select("b", "a")).distinct(), "links")
    labels = stored(both.groupBy(F.col("a").alias("cls")).agg(F.min("b").alias("near"))
                    .select("cls", F.least("cls", "near").alias("label")), "labels")
    while True:
        near = (both.join(labels.select(F.col("cls").alias("b"), "label"), "b")
                .groupBy(F.col("a").alias("cls")).agg(F.min("label").alias("near")))
        spread = labels.join(near, "cls").select("cls", F.col("label").alias("was"), F.least("label", "near").alias("label"))
        # Jump: a label is a class itself, and may have a smaller label by now.
        jump = spread.alias("x").join(spread.select(F.col("cls").alias("at"), F.col("label").alias("jumped")).alias("y"),
                                      F.col("x.label") == F.col("y.at")).select("cls", "was", F.col("jumped").alias("label"))
        new = stored(jump, "labels")
        labels = new.select("cls", "label")
        if not new.filter("was <> label").limit(1).count():
            return labels


def bitmap(s: np.ndarray) -> np.ndarray:
    """Per bit the parity of the shingles that fall on it: the bitmaps of two sets differ in no
    more bits than the sets have elements apart."""
    bits = np.bincount((s >> np.uint64(20)).astype(np.int64) & (64 * BITMAP - 1), minlength=64 * BITMAP) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.int64)


def linked(labels: DataFrame, links: DataFrame) -> DataFrame:
    """``labels`` (cls, label) after more links (a, b): a graph of the labels they join."""
    of = lambda c: labels.select(F.col("cls").alias(c), F.col("label").alias(f"l{c}"))
    joints = (links.join(of("a"), "a", "left").join(of("b"), "b", "left")
              .select(F.coalesce("la", "a").alias("a"), F.coalesce("lb", "b").alias("b")).distinct())
    new = components(joints).toDF("joined", "new")
    ends = links.select(F.col("a").alias("cls")).union(links.select(F.col("b").alias("cls"))).distinct()
    alone = ends.join(labels, "cls", "left_anti").select("cls", F.col("cls").alias("label"))
    return stored(labels.unionByName(alone).join(new, F.col("label") == F.col("joined"), "left")
                  .select("cls", F.coalesce("new", "label").alias("label")), "labels")


def mixed_bands(bands: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of ``bands`` with their label, of bands of three classes or more that hold several
    components (in a band of two, the star has seen the only pair)."""
    named = bands.join(labels, "cls", "left").select(*bands.columns, F.coalesce("label", "cls").alias("label"))
    mixed = named.groupBy("key").agg(F.count(F.lit(1)).alias("m"), F.min("label").alias("lo"), F.max("label").alias("hi"))
    return named.join(mixed.filter("m > 2 and lo <> hi").select("key"), "key")


def again(bands: DataFrame, labels: DataFrame, sets: DataFrame, size: int = WORDS) -> DataFrame:
    """``labels`` after rounds of stars with new leads, until a round adds no link."""
    rounds = 0
    while True:
        rounds += 1
        named = stored(mixed_bands(bands, labels), "mixed")
        leads = named.groupBy("key").agg(F.max(F.struct(F.xxhash64(F.lit(rounds), "key", "cls").alias("draw"), F.col("cls").alias("a"),
                                                        F.col("n").alias("na"), F.col("label").alias("la"))).alias("lead")).select("key", "lead.*")
        pairs = named.join(leads, "key").filter((F.col("label") != F.col("la")) & alike_in_size(F.col("n"), F.col("na")))
        pairs = pairs.select(F.least("a", "cls").alias("a"), F.greatest("a", "cls").alias("b")).distinct()
        found = stored(confirm(pairs, sets, size), "round-links")
        if not found.limit(1).count():
            return labels
        labels = linked(labels, found)


def residual(bands: DataFrame, labels: DataFrame, sets: DataFrame, size: int = WORDS) -> DataFrame:
    """Pairs (a, b) of different components that the stars may have missed: all pairs that
    can reach the similarity among the classes of mixed bands of three classes or more."""
    open_ = mixed_bands(bands, labels).select("cls", "label").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                piece = b.slice(at, 256)
                texts = [unpack.decompress(x).decode("utf-8", "surrogatepass") for x in piece.column(2).to_pylist()]
                for i, s in enumerate(shingles(texts, size)):
                    n = len(s)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.full(n, piece.column(0)[i].as_py(), np.int64)),
                         pa.array(np.full(n, piece.column(1)[i].as_py(), np.int64)),
                         pa.array(s.view(np.int64)), pa.array(np.full(n, n, np.int64)),
                         pa.array([bitmap(s)] * n, pa.list_(pa.int64()))], ["cls", "label", "shingle", "n", "bits"])

    items = stored(open_.join(sets, "cls").select("cls", "label", "packed")
                   .mapInArrow(run, "cls long, label long, shingle long, n long, bits array<long>"), "residual")
    often = items.groupBy("shingle").agg(F.count(F.lit(1)).alias("often")).filter("often > 1")
    # The rarest come first; a set's last ceil(0.75 n) - 1 shingles cannot be the only common ones.
    # Shingles of one class alone take their share of the prefix, but pair with nothing.
    rank = F.row_number().over(Window.partitionBy("cls").orderBy("often", "shingle"))
    shared = items.join(often, "shingle")
    some = shared.groupBy("cls").agg(F.count(F.lit(1)).alias("some"))
    prefix = (shared.withColumn("rank", rank).join(some, "cls")
              .withColumn("at", F.col("n") - F.col("some") + F.col("rank"))
              .filter(F.col("at") <= F.col("n") - F.ceil(F.col("n") * PERCENT / 100) + 1)
              .select("shingle", "cls", "label", "n", "at", "bits"))
    main = (prefix.groupBy("shingle", "label").agg(F.count(F.lit(1)).alias("c"))
            .groupBy("shingle").agg(F.max_by("label", "c").alias("main"), F.count(F.lit(1)).alias("labels"))
            .filter("labels > 1"))
    told = stored(prefix.join(main, "shingle").select("shingle", "cls", "label", "n", "at", "bits", (F.col("label") != F.col("main")).alias("stray")), "prefix")
    x = told.filter("stray").select("shingle", F.col("cls").alias("a"), F.col("label").alias("la"), F.col("n").alias("na"), F.col("at").alias("ia"), F.col("bits").alias("ba"))
    y = told.select("shingle", F.col("cls").alias("b"), F.col("label").alias("lb"), F.col("n").alias("nb"), F.col("at").alias("ib"),
                    F.col("stray").alias("sb"), F.col("bits").alias("bb"))
    # From the first common shingle on, at most so many can be common; a link needs
    # 100 c >= PERCENT (na + nb - c).
    most = 1 + F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib"))
    enough = most * (100 + PERCENT) >= (F.col("na") + F.col("nb")) * PERCENT
    # 100 c >= PERCENT (na + nb - c) also bounds how many elements the sets have apart.
    apart = sum((F.bit_count(F.col("ba")[i].bitwiseXOR(F.col("bb")[i])) for i in range(1, BITMAP)), F.bit_count(F.col("ba")[0].bitwiseXOR(F.col("bb")[0])))
    enough &= apart * (100 + PERCENT) <= (F.col("na") + F.col("nb")) * (100 - PERCENT)
    return (x.join(y, "shingle").filter((F.col("la") != F.col("lb")) & (~F.col("sb") | (F.col("a") < F.col("b")))
                                        & enough & alike_in_size(F.col("na"), F.col("nb")))
            .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct())


def judge_rows(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, mark, n_shingles, label (the component's class; null without words),
    component_id, kept: a row per row of ``docs`` (doc_id, text)."""
    sketches = sketch(docs, size)
    sizes = (sketches.filter("cls is not null").groupBy("cls")
             .agg(F.min("doc_id").alias("first_doc"), F.max("n_shingles").alias("n")))
    keys = sketches.filter("cls is not null").select("cls", F.explode("bands").alias("key"))
    shared = keys.groupBy("key").agg(F.min("cls").alias("least"), F.max("cls").alias("last")).filter("least <> last")
    bands = stored(keys.join(shared, "key").select("key", "cls").distinct().join(sizes.select("cls", "n"), "cls"), "bands")
    active = bands.select("cls").distinct().join(sizes, "cls")
    # The class that meets most others leads its bands.
    met = bands.join(bands.groupBy("key").agg(F.count(F.lit(1)).alias("m")), "key").groupBy("cls").agg(F.sum("m").alias("met"))
    leads = bands.join(met, "cls").groupBy("key").agg(F.max(F.struct("met", F.col("cls").alias("lead"), F.col("n").alias("nl"))).alias("x")).select("key", "x.lead", "x.nl")

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        squeeze = zstandard.ZstdCompressor(level=3)
        for b in (x.slice(at, 512) for x in batches for at in range(0, x.num_rows, 512)):
            cls, n, texts = (b.column(i).to_pylist() for i in range(3))
            mine = [class_of(s) == c if len(s) else False for s, c in zip(shingles(texts, size), cls, strict=True)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([c for c, m in zip(cls, mine, strict=True) if m], pa.int64()),
                 pa.array([x for x, m in zip(n, mine, strict=True) if m], pa.int64()),
                 pa.array([squeeze.compress(t.encode("utf-8", "surrogatepass")) for t, m in zip(texts, mine, strict=True) if m],
                          pa.binary())], ["cls", "n", "packed"])

    # A doc_id may stand for several texts; the checksum tells the right one. Rows of the
    # same doc_id and text are cut to one by the class.
    texts = docs.select(F.col("doc_id").cast("long").alias("d"), F.col("text").cast("string").alias("text"))
    sets = stored(texts.join(active, F.col("d").eqNullSafe(F.col("first_doc"))).select("cls", "n", "text")
                  .mapInArrow(pack, "cls long, n long, packed binary").dropDuplicates(["cls"]), "sets")

    star = (bands.join(leads, "key").filter((F.col("cls") != F.col("lead")) & alike_in_size(F.col("n"), F.col("nl")))
            .select(F.least("lead", "cls").alias("a"), F.greatest("lead", "cls").alias("b")).distinct())
    links = stored(confirm(star, sets, size), "star-links")
    labels = again(bands, components(links), sets, size)
    missed = stored(confirm(residual(bands, labels, sets, size), sets, size), "missed-links")
    if missed.limit(1).count():
        labels = linked(labels, missed)
    named = sizes.join(labels, "cls", "left").select("cls", "first_doc", F.coalesce("label", "cls").alias("label"))

    firsts = named.groupBy("label").agg(F.min("first_doc").alias("component_id"))
    of_class = named.join(firsts, "label").select(F.col("cls").alias("c"), "label", "component_id")
    out = sketches.select("doc_id", "mark", "n_shingles", "cls").join(of_class, F.col("cls") == F.col("c"), "left")
    component = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "mark", "n_shingles", "label", component.alias("component_id"),
                      F.col("doc_id").eqNullSafe(component).alias("kept"))


def near_duplicates(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, component_id, kept: a row per row of ``docs`` (doc_id, text)."""
    return judge_rows(docs, size).select("doc_id", "n_shingles", "component_id", "kept")


def first_of_each(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """One document of each group of near-duplicates, all columns kept; texts without words
    all stay. A row is known by doc_id and text, so ids may be null or repeated: of a group's
    rows with its smallest id, one stays."""
    at, mark = fresh(docs, "kept_id", "kept_mark")
    found = judge_rows(docs, size).filter("kept and label is not null")
    kept = found.groupBy("label").agg(F.min("component_id").alias(at), F.min("mark").alias(mark)).drop("label")
    worded = F.coalesce(F.col("text").cast("string").rlike(WORD), F.lit(False))
    some = docs.filter(worded).join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col(at)) & (text_mark() == F.col(mark)))
    some = some.dropDuplicates([at, mark])
    return some.select(*[f"`{c}`" for c in docs.columns]).unionByName(docs.filter(~worded))


ORACLE = r"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                     'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
     s AS (SELECT DISTINCT doc_id, list_slice(w, i, i + 4) AS sh
           FROM (SELECT doc_id, w, unnest(generate_series(1, greatest(1, len(w) - 4))) AS i FROM d WHERE len(w) > 0)),
     n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
     p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.sh = b.sh AND a.doc_id <> b.doc_id GROUP BY 1, 2),
     l AS (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * c >= 75 * (x.n + y.n - c)),
     r AS (SELECT doc_id AS a, doc_id AS b FROM d UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
     m AS (SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a)
SELECT doc_id, coalesce(n, 0) AS n_shingles, component_id, doc_id = component_id AS kept FROM m LEFT JOIN n USING (doc_id)
"""
