"""Normal forms by language: rules are registered under a code, and one table function serves all languages of a job."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import udtf

#: Affixes of Indonesian.
IND_SUFFIXES = ("an", "i", "kah", "ku", "lah", "mu", "nya", "pun")
IND_PREFIXES = ("ber", "di", "ke", "me", "mem", "men", "meng", "meny", "pe", "per", "se", "ter")


@dataclass(frozen=True)
class Affixes:
    """The word, and what is left of it without one suffix, then one prefix, of `least` letters or more, longest first."""

    suffixes: tuple[str, ...] = ()
    prefixes: tuple[str, ...] = ()
    least: int = 3

    def __call__(self, word: str) -> list[str]:
        low = word.lower()
        base = [low, *(low[: -len(s)] for s in self.suffixes if low.endswith(s) and len(low) - len(s) >= self.least)]
        bare = [b[len(p) :] for b in base for p in self.prefixes if b.startswith(p) and len(b) - len(p) >= self.least]
        return [low, *sorted({*base, *bare} - {low}, key=lambda x: (-len(x), x))]


Rule = Callable[[str], list[str]]
REGISTERED: dict[str, Rule] = {"ind": Affixes(IND_SUFFIXES, IND_PREFIXES)}


def register(iso: str, rule: Rule) -> None:
    """Use `rule` (word to forms, the word in lower case first) for a language from now on."""
    REGISTERED[iso] = rule


def forms_table(words: DataFrame, rules: dict[str, Rule] | None = None, iso: str = "iso", parts: int = 64) -> DataFrame:
    """iso, word (in lower case) and forms of each different word, by the rule of its language, or lower case alone.

    words: iso and word. The words of a language are dealt into `parts` partitions of the table function, so that no
    language is one task; each partition looks its rule up once.
    """
    rules = dict(REGISTERED if rules is None else rules)

    @udtf(returnType="iso string, word string, forms array<string>")
    class Normalize:
        def __init__(self):
            self.now, self.rule = None, None

        def eval(self, row) -> Iterable[tuple[str, str, list[str]]]:
            if self.rule is None or row["iso"] != self.now:
                self.now, self.rule = row["iso"], rules.get(row["iso"], Affixes())
            forms: Iterator[str] = self.rule(row["word"])
            yield row["iso"], row["word"], list(dict.fromkeys(forms))

    own = words.select(F.col(iso).alias("iso"), F.lower("word").alias("word")).where(F.col("word").isNotNull()).distinct()
    dealt = own.withColumn("deal", F.pmod(F.xxhash64("word"), F.lit(parts)))
    return Normalize(dealt.asTable().partitionBy("iso", "deal"))
