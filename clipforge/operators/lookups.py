"""Configuration lookups and dictionary tagging.

Configuration maps are small by construction, so they are map literals in the
expression (no join at all); data-sized maps go through an ordinary join, and a
dictionary held in a table through :func:`table_tags`.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from clipforge.functions import constants as C
from clipforge.functions.text import col_, faculty_label_from_path
from clipforge.session import written


def map_literal(mapping: dict) -> Column:
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs) if pairs else F.create_map().cast("map<string,string>")


def lookup(c, mapping: dict, default=None) -> Column:
    """``mapping.get(c, default)``; ``default`` may be a column (e.g. the key itself)."""
    v = F.try_element_at(map_literal(mapping), col_(c))
    if default is None:
        return v
    return F.coalesce(v, default if isinstance(default, Column) else F.lit(default))


def faculty_code(path) -> Column:
    """Faculty label from the mail file name mapped to its code; unknown labels kept."""
    label = faculty_label_from_path(path)
    return F.when(label.isNotNull(), lookup(label, C.FACULTY_MAP, label))


def workflow(faculty) -> Column:
    """Workflow step of a faculty code; ``approved`` otherwise (also for null)."""
    return F.coalesce(lookup(faculty, C.WORKFLOW_STATUS), F.lit(C.DEFAULT_WORKFLOW))


def workflow_struct(faculty) -> Column:
    s = workflow(faculty)
    return F.struct(s.alias("step"), F.struct(s.alias("en_GB")).alias("description"))


def fill_source_urls(df: DataFrame, source_col: str = "source", url_col: str = "url",
                     mapping: dict = C.SOURCE_URL_MAP) -> DataFrame:
    """Fill an empty URL from the source's home page (source matched lower-cased)."""
    home = lookup(F.lower(F.col(source_col)), mapping)
    empty = F.col(url_col).isNull() | (F.col(url_col) == "")
    return df.withColumn(url_col, F.when(empty, F.coalesce(home, F.col(url_col))).otherwise(F.col(url_col)))


def dictionary_tags(text, names: list, none_value: str = "not found") -> Column:
    """Every listed name that is a case-sensitive substring of the text (sorted);
    ``[none_value]`` when none is."""
    hits = F.array_sort(F.filter(F.array(*[F.lit(n) for n in names]), lambda n: F.instr(col_(text), n) > 0)) \
        if names else F.array().cast("array<string>")
    return F.when(F.size(hits) > 0, hits).otherwise(F.array(F.lit(none_value)))


#: Longest start of a name's anchor that is looked up inside the texts' words.
ANCHOR_CHARS = 8
#: Names of so many bytes, with NAME_BYTES for each, go to every task; more of them meet the texts by joins.
DICTIONARY_BYTES = 16 << 20
NAME_BYTES = 64
#: A task answers so many texts, bytes of text, and texts times names at once (one text at least).
TEXTS_AT_ONCE = 256
BYTES_AT_ONCE = 2 << 20
CELLS_AT_ONCE = 8 << 20

#: Most windows of a text are no piece; a table of so many bits screens them.
SCREEN_BITS = 18

_BLANKS = bytes.maketrans(b"\t\r\n", b"   ")


def _tokens(c) -> Column:
    """Runs without a space, tab or line end."""
    return F.filter(F.split(col_(c), "[ \\t\\r\\n]+"), lambda t: t != "")


def _lists(values: list) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Lists laid end to end, with the start and the length of each."""
    sizes = np.array([len(x) for x in values], np.int64)
    return np.array([y for x in values for y in x], np.int64), np.cumsum(sizes) - sizes, sizes


def _laid(flat: np.ndarray, starts: np.ndarray, sizes: np.ndarray, owner: np.ndarray, which: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The members of the lists ``which``, and the owner of the list beside each."""
    n = sizes[which]
    return np.repeat(owner, n), flat[np.repeat(starts[which] - (np.cumsum(n) - n), n) + np.arange(n.sum())]


def _slot(x: np.ndarray) -> np.ndarray:
    return ((x * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - SCREEN_BITS)).astype(np.int64)


class Pieces:
    """Pieces of at most ``ANCHOR_CHARS`` bytes, as numbers, by their form, with the names under each."""

    def __init__(self, pairs: list[tuple[object, bytes, int]]):
        by = defaultdict(lambda: defaultdict(set))
        for form, piece, name in pairs:
            by[form][piece].add(name)
        self.keys, named = {}, []
        for form in sorted(by):
            own = sorted((int.from_bytes(x, "little"), x) for x in by[form])
            keys, screen = np.array([x[0] for x in own], np.uint64), np.zeros(1 << SCREEN_BITS, bool)
            screen[_slot(keys)] = True
            self.keys[form] = len(named), np.uint64((1 << 8 * len(own[0][1])) - 1), keys, screen
            named += [sorted(by[form][x[1]]) for x in own]
        self.count, self.lists = len(named), _lists(named)

    def held(self, windows, text: np.ndarray, unit: np.ndarray, shape: tuple[int, int]) -> np.ndarray:
        """Whether a text holds a piece of a name (texts by names): ``windows`` gives for a form the windows
        to look at, and beside each its unit, ascending; ``text`` holds the ``unit`` beside it."""
        met = np.zeros(shape[0] * self.count, bool)
        for form, (base, mask, keys, screen) in self.keys.items():
            x, of = windows(form)
            x = x & mask
            may = np.flatnonzero(screen[_slot(x)])
            x, of = x[may], of[may]
            i = np.minimum(np.searchsorted(keys, x), len(keys) - 1)
            hit = keys[i] == x
            i, of = i[hit], of[hit]
            first = np.searchsorted(of, np.arange(unit.max(initial=-1) + 2))
            texts, pieces = _laid(i, first[:-1], np.diff(first), text, unit)
            met[texts * self.count + base + pieces] = True
        texts, names = _laid(*self.lists, *np.divmod(np.flatnonzero(met), max(self.count, 1)))
        out = np.zeros(shape[0] * shape[1], bool)
        out[texts * shape[1] + names] = True
        return out


def _windows(data: np.ndarray, at: np.ndarray) -> np.ndarray:
    """The ``ANCHOR_CHARS`` bytes from each place on, as a number."""
    out = np.zeros(len(at), np.uint64)
    for k in range(ANCHOR_CHARS):
        out |= data[at + k].astype(np.uint64) << np.uint64(8 * k)
    return out


class NameIndex:
    """The names of a dictionary, as bytes: ``names`` are (number, name).

    A name of one token is looked up by its first ``ANCHOR_CHARS`` bytes in the words of the texts, a longer
    one by as many bytes about its first blank at the blanks of the texts (few other places are alike). What
    that leaves open is looked up in the text."""

    def __init__(self, names: list[tuple[int, bytes]]):
        self.nos, self.names = np.array([x[0] for x in names], np.int64), [x[1] for x in names]
        self.sure = np.zeros(len(names), bool)
        words, joints = [], []
        for i, name in enumerate(self.names):
            inner = name.strip(b" \t\r\n")
            blank = inner.translate(_BLANKS).find(b" ")
            if blank < 0:
                piece = inner[:ANCHOR_CHARS]
                words.append((len(piece), piece, i))
                self.sure[i] = name == piece
            else:
                before = min(blank, ANCHOR_CHARS // 2 - 1)
                piece = inner[blank - before:blank + ANCHOR_CHARS // 2 + 1]
                joints.append(((before, len(piece)), piece, i))
        self.words, self.joints = Pieces(words), Pieces(joints)

    def of_texts(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Places of texts, ascending, with the numbers of the names that each holds."""
        ids: dict[bytes, int] = {}
        plain = [x.translate(_BLANKS) for x in texts]
        word, _, sizes = _lists([[ids.setdefault(w, len(ids)) for w in set(x.split(b" "))] for x in plain])
        text, each, pad = np.repeat(np.arange(len(texts)), sizes), np.arange(len(texts)), b" " * ANCHOR_CHARS
        shape = len(texts), len(self.names)

        data = np.frombuffer(b" ".join(ids) + pad, np.uint8)  # no piece of a word holds a blank
        windows = _windows(data, np.arange(len(data) - ANCHOR_CHARS + 1))
        owner = np.repeat(np.arange(len(ids)), [len(w) + 1 for w in ids])
        met = self.words.held(lambda form: (windows, owner), text, word, shape)

        data = np.frombuffer(pad + b" ".join(texts) + pad, np.uint8)
        at = np.flatnonzero(np.frombuffer(pad + b" ".join(plain) + pad, np.uint8) == ord(" "))
        at = at[(at >= ANCHOR_CHARS) & (at < len(data) - ANCHOR_CHARS)]
        of = np.searchsorted(np.cumsum([len(x) + 1 for x in texts]), at - ANCHOR_CHARS, "right")
        by = {before: _windows(data, at - before) for before in {x[0] for x in self.joints.keys}}
        met |= self.joints.held(lambda form: (by[form[0]], of), each, each, shape)

        which, name = np.divmod(np.flatnonzero(met), max(len(self.names), 1))
        there = self.sure[name]
        for i in np.flatnonzero(~there).tolist():
            there[i] = self.names[name[i]] in texts[which[i]]
        return which[there], self.nos[name[there]]


def _tag(names: list):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = NameIndex(names)
        most = max(1, min(TEXTS_AT_ONCE, CELLS_AT_ONCE // max(len(index.names), 1)))
        for rows in batches:
            ends = np.cumsum(pc.binary_length(rows.column(1)).to_numpy(zero_copy_only=False).astype(np.int64))
            at = 0
            while at < rows.num_rows:
                begun = ends[at - 1] if at else 0
                end = min(at + most, max(at + 1, int(np.searchsorted(ends, begun + BYTES_AT_ONCE, "right"))))
                part = rows.slice(at, end - at)
                which, nos = index.of_texts(part.column(1).to_pylist())
                offsets = np.searchsorted(which, np.arange(part.num_rows + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.ListArray.from_arrays(offsets, nos)], ["_id", "nos"])
                at = end
    return run


def _tags_by_dictionary(texts: DataFrame, name: DataFrame) -> DataFrame:
    """(_id, name) where every task holds all names. Nothing of a text is shuffled: the names are looked up
    in a text as it is read. Only rows of repeated ids are told apart by a shuffle."""
    found = written(name.select("no", "name", F.get(_tokens("name"), F.lit(0)).alias("word")), "tag_found")
    index = sorted((r[0], bytes(r[1])) for r in found.select("no", F.col("name").cast("binary")).collect())  # DICTIONARY_BYTES at most
    schema = T.StructType([texts.schema["_id"], T.StructField("nos", T.ArrayType(T.LongType()))])
    hits = written(texts.select("_id", F.col("_text").cast("binary")).mapInArrow(_tag(index), schema), "tag_hits")
    again = hits.groupBy("_id").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1).select("_id")
    once = hits.join(again, "_id", "left_anti").select("_id", F.explode("nos").alias("no"))
    often = hits.join(again, "_id", "left_semi").select("_id", F.explode("nos").alias("no")).distinct()
    return once.unionByName(often).join(F.broadcast(name), "no")


def table_tags(docs: DataFrame, names: DataFrame, id_col: str, text_col: str, name_col: str = "name") -> DataFrame:
    """(id, name): every name of a table of any size that is a case-sensitive substring of a text.

    Names of up to ``DICTIONARY_BYTES`` are held by every task (``_tags_by_dictionary``); more meet the
    texts by joins. There a name's anchor is its rarest token by the texts' own word counts. A text that holds the
    name has a word that holds the anchor, so anchors are looked up in the distinct words of
    all texts, not in the texts: words are cut into the pieces of the lengths that anchors
    start with (``ANCHOR_CHARS`` at most) and joined on the piece. The first token of a longer
    name must end its word, the last one start its word, any other be the word. Documents then meet names
    by their words, an equi-join. A name of several tokens is verified in the whole text, each
    text once with its own candidates. Null and blank names, and rows with a null id, have no
    tags; a repeated id is one document per distinct text."""
    texts = docs.select(F.col(id_col).alias("_id"), F.col(text_col).alias("_text")).where(F.col("_id").isNotNull() & F.col("_text").isNotNull())
    # names go through the shuffles as numbers
    name = names.select(F.col(name_col).alias("name")).where(F.col("name").rlike("[^ \\t\\r\\n]")).distinct()
    name = written(name.withColumn("no", F.monotonically_increasing_id()), "tag_names")
    if (name.agg(F.sum(F.octet_length("name") + NAME_BYTES)).first()[0] or 0) <= DICTIONARY_BYTES:
        return _tags_by_dictionary(texts, name).select(F.col("_id").alias(id_col), "name")
    keyed = texts.withColumn("_key", F.xxhash64("_id", "_text"))
    held = keyed.select("_key", "_id", F.explode(F.array_distinct(_tokens("_text"))).alias("word"))
    words = written(held.groupBy("word").agg(F.count(F.lit(1)).alias("n")), "tag_words")

    parts = name.select("no", "name", F.size(_tokens("name")).alias("of"), F.posexplode(_tokens("name")).alias("i", "anchor"))
    place = F.when(F.col("of") == 1, "only").when(F.col("i") == 0, "first").when(F.col("i") == F.col("of") - 1, "last").otherwise("inner")
    parts = parts.select("no", "name", "anchor", place.alias("place"))
    rank = F.struct(F.coalesce("n", F.lit(0)).alias("n"), (-F.length("anchor")).alias("l"), F.col("anchor"), F.col("place"))
    anchors = (parts.join(words.withColumnRenamed("word", "anchor"), "anchor", "left").groupBy("no", "name").agg(F.min(rank).alias("r"))
               .select("no", "name", F.col("r.anchor").alias("anchor"), F.col("r.place").alias("place"), F.substring("r.anchor", 1, ANCHOR_CHARS).alias("piece")))
    anchors = written(anchors.withColumn("size", F.length("piece")), "tag_anchors")
    sizes = sorted(r[0] for r in anchors.select("size").distinct().collect())  # at most ANCHOR_CHARS values
    starts = F.sequence(F.lit(1), F.length("word"))
    cut = lambda k: F.transform(starts, lambda at: F.substr(F.col("word"), at, F.lit(k)))
    cuts = [cut(k) for k in sizes]
    pieces = F.flatten(F.array(*cuts)) if cuts else F.array().cast("array<string>")
    word, anchor = F.col("word"), F.col("anchor")
    stands = (F.when(F.col("place") == "only", F.contains(word, anchor)).when(F.col("place") == "first", F.endswith(word, anchor))
              .when(F.col("place") == "last", F.startswith(word, anchor)).otherwise(word == anchor))
    found = words.select("word", F.explode(F.array_distinct(pieces)).alias("piece")).join(anchors, "piece").where(stands)
    hit = F.struct("no", (F.col("name") == F.col("anchor")).alias("whole"))
    found = written(found.groupBy("word").agg(F.collect_set(hit).alias("hits")), "tag_found")

    near = held.join(found, "word").select("_key", "_id", F.explode("hits").alias("hit"))
    near = written(near.groupBy("_key", "_id", "hit.no").agg(F.max("hit.whole").alias("whole")), "tag_candidates")
    sure = near.where("whole").select("_id", "no")
    check = near.where(~F.col("whole")).join(name, "no").groupBy("_key").agg(F.collect_set(F.struct("no", "name")).alias("names"))
    verified = (check.join(keyed.dropDuplicates(["_key"]), "_key")
                .select("_id", F.explode(F.filter("names", lambda n: F.contains(F.col("_text"), n["name"]))).alias("n")).select("_id", "n.no"))
    return sure.unionByName(verified).distinct().join(name, "no").select(F.col("_id").alias(id_col), "name")
