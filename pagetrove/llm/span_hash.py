"""Document fingerprints by prefix polynomial hashes.

``PrefixHash`` keeps, for every prefix of a text, the polynomial sum(c[i] * BASE**i) under two prime
moduli. A span's polynomial is the difference of two prefixes, so the equality of any two spans takes
a few multiplications, and the longest common extension of two places is found by binary search.
"""

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagetrove.llm.common import even_cuts, in_slices, part_of

# Two primes below 2**31 and a base for each. With code points shifted by one, products
# fit into 64 bits, and so do the sums of up to 2**32 terms.
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 998244353)
BLOCK = 32  # code points of the blocks by which moved text is found again


class _Powers:
    """Powers of the bases, grown as longer texts come."""

    def __init__(self):
        self.tables = [np.ones(1, dtype=np.uint64) for _ in PRIMES]

    def upto(self, count):
        while len(self.tables[0]) < count:
            for k, (prime, base) in enumerate(zip(PRIMES, BASES)):
                table = self.tables[k]
                jump = np.uint64(pow(base, len(table), prime))
                self.tables[k] = np.concatenate([table, table * jump % np.uint64(prime)])
        return [table[:count] for table in self.tables]


_POWERS = _Powers()


class PrefixHash:
    """Prefix arrays of one text."""

    def __init__(self, text: str):
        points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4").astype(np.uint64) + np.uint64(1)
        self.size = len(points)
        self.sums = []
        for prime, power in zip(PRIMES, _POWERS.upto(self.size + 1)):
            sums = np.zeros(self.size + 1, dtype=np.uint64)
            np.cumsum(points * power[:self.size] % np.uint64(prime), out=sums[1:])
            self.sums.append(sums % np.uint64(prime))

    def digest(self) -> str:
        """24 hex digits: length and both polynomials of the whole text."""
        return f"{self.size & 0xFFFFFFFF:08x}" + "".join(f"{int(sums[-1]):08x}" for sums in self.sums)

    def spans(self, starts: np.ndarray, width: int, common: int) -> np.ndarray:
        """One number per span [start, start + width): both polynomials, raised to the power that
        they would have at ``common``, which must be no smaller than any start."""
        powers = _POWERS.upto(common + 1)
        out = []
        for prime, sums, power in zip(PRIMES, self.sums, powers):
            p = np.uint64(prime)
            out.append((sums[starts + width] + p - sums[starts]) % p * power[common - starts] % p)
        return out[0] << np.uint64(32) | out[1]

    def span_equal(self, start: int, other: "PrefixHash", at: int, width: int) -> bool:
        """Is [start, start + width) here the same text as [at, at + width) there?"""
        common = max(start, at)
        for k, prime in enumerate(PRIMES):
            power = _POWERS.upto(common + 1)[k]
            mine = (int(self.sums[k][start + width]) - int(self.sums[k][start])) * int(power[common - start])
            theirs = (int(other.sums[k][at + width]) - int(other.sums[k][at])) * int(power[common - at])
            if (mine - theirs) % prime:
                return False
        return True

    def extension(self, start: int, other: "PrefixHash", at: int) -> int:
        """Length of the longest common extension to the right of two places."""
        low, high = 0, min(self.size - start, other.size - at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span_equal(start, other, at, middle):
                low = middle
            else:
                high = middle - 1
        return low

    def extension_back(self, end: int, other: "PrefixHash", at: int) -> int:
        """Length of the longest common extension to the left of two ends."""
        low, high = 0, min(end, at)
        while low < high:
            middle = (low + high + 1) // 2
            if self.span_equal(end - middle, other, at - middle, middle):
                low = middle
            else:
                high = middle - 1
        return low


def likeness(one: PrefixHash, two: PrefixHash) -> float:
    """Share of text that two fingerprints have in common, from 0 to 1; 1 means equal texts.

    Common start and end are found by longest common extensions. In between, blocks of ``one`` are
    looked up among all spans of their width in ``two``, and every block found is extended both ways.
    The share is twice the common length over the sum of the lengths. Two empty texts have likeness 1.
    """
    if one.size == two.size and all(a[-1] == b[-1] for a, b in zip(one.sums, two.sums)):
        return 1.0
    front = one.extension(0, two, 0)
    shorter = min(one.size, two.size) - front
    back = min(one.extension_back(one.size, two, two.size), shorter)
    common = front + back
    begin, end = front, one.size - back
    there = two.size - back - front
    if end - begin >= BLOCK and there >= BLOCK:
        top = max(one.size, two.size)
        places = np.arange(front, front + there - BLOCK + 1)
        known = two.spans(places, BLOCK, top)
        starts = np.arange(begin, end - BLOCK + 1, BLOCK)
        wanted = one.spans(starts, BLOCK, top)
        order = np.argsort(known, kind="stable")
        spot = np.minimum(np.searchsorted(known[order], wanted), len(known) - 1)
        at = order[spot]
        found = known[at] == wanted
        reached = begin
        for start, place in zip(starts[found].tolist(), places[at[found]].tolist()):
            if start + BLOCK <= reached:
                continue
            left = min(one.extension_back(start, two, place), max(0, start - reached))
            right = min(one.extension(start, two, place), end - start)
            common += start + right - max(reached, start - left)
            reached = start + right
    size = one.size + two.size
    return min(1.0, 2.0 * min(common, one.size, two.size) / size) if size else 1.0


def replaced_tail(text: str, following: str) -> str:
    """The text with its last third replaced by as much of the following text as there is."""
    cut = len(text) // 3
    return text[:len(text) - cut] + following[:cut]


_OUT = ("doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
        "near_edited double, near_next double")


def _in_order(batches):
    """Rows come by part, lent rows last. A row is finished when the row after it is there."""
    before, known = None, None
    names = [piece.split()[0] for piece in _OUT.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
    for columns in in_slices(batches, 256):
        done = []
        for row in zip(*columns):
            after = None
            if before and before[0] == row[0] and not before[2]:
                text, following = before[3], row[3]
                mine, after = known or PrefixHash(text), PrefixHash(following)
                edited = replaced_tail(text, following)
                changed = PrefixHash(edited)
                done.append((before[1], mine.size, hashlib.sha256(edited.encode()).hexdigest(),
                             mine.digest(), changed.digest(), likeness(mine, changed),
                             likeness(mine, after)))
            before, known = row, after
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(values), type=kind)
             for values, kind in zip(zip(*done) if done else [()] * len(types), types)], names=names)


def compare_with_next(docs: DataFrame) -> DataFrame:
    """For every row (doc_id, text, any others): the fingerprint of its text, that of its edited text,
    and their likeness, and the likeness to the next row's text.

    The next row has the next smaller doc_id; the last row is followed by the first, so a lone row is
    followed by itself. Rows with equal doc_id are put in the order of their texts, rows without a
    doc_id come last; a null text is empty. The edited text is ``replaced_tail``. An empty table gives
    no rows.

    Texts move once: the range of ids is cut at approximate quantiles into four parts for every
    shuffle partition, and each part's first row is lent to the part before it. The driver gets one id
    for each part.
    """
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    cuts = even_cuts(docs, "doc_id", 4 * tasks)
    keyed = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn(
        "part", part_of(F.col("doc_id"), cuts))
    tops = {row["part"]: row["top"] for row in keyed.groupBy("part").agg(
        F.max("doc_id").alias("top")).collect()}
    parts = sorted(tops, reverse=True)
    borrower = F.create_map(*[F.lit(x) for i, part in enumerate(parts) for x in (part, parts[i - 1])]
                            ) if parts else F.lit(None).cast("map<int,int>")
    is_top = F.when(F.col("doc_id").isNull(), F.lit(None in tops.values())).otherwise(
        F.col("doc_id").isin([top for top in tops.values() if top is not None]))
    own = F.struct(F.col("part").alias("part"), F.lit(False).alias("borrowed"))
    lent = F.struct(borrower[F.col("part")].alias("part"), F.lit(True).alias("borrowed"))
    places = F.when(is_top, F.array(own, lent)).otherwise(F.array(own))
    dealt = keyed.select("doc_id", "text", F.inline(places))
    return (
        dealt.repartition(tasks, "part")
        .sortWithinPartitions("part", "borrowed", F.desc_nulls_last("doc_id"), "text")
        .select("part", "doc_id", "borrowed", "text")
        .mapInArrow(_in_order, _OUT)
    )
