"""Stop words, irregular word forms and suffix rules for the normaliser."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from review_pulse.functions.text import cleaned_words

# The English stop words Spark MLlib ships (StopWordsRemover default).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him his himself she her
hers herself it its itself they them their theirs themselves what which who whom this that these
those am is are was were be been being have has had having do does did doing a an the and but if or
because as until while of at by for with about against between into through during before after
above below to from up down in out on off over under again further then once here there when where
why how all any both each few more most other some such no nor not only own same so than too very s
t can will just don should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd
they'd i'm you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't
weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't mustn't can't
couldn't cannot could here's how's let's ought that's there's what's when's where's who's why's
would
""".split()

# Cleaning drops apostrophes, so contractions that cannot be read as another word count as well.
CLEANED_STOP_WORDS = STOP_WORDS + sorted(
    w.replace("'", "") for w in STOP_WORDS if w.endswith(("n't", "'ve", "'m", "u're", "y're"))
)

# Irregular English forms, "lemma: form form ...".
_IRREGULAR = """
bad: worse worst
become: became
begin: began begun
bite: bit bitten
blow: blew blown
break: broke broken
bring: brought
build: built
buy: bought
catch: caught
child: children
choose: chose chosen
come: came
cost: costs
deal: dealt
die: dies died dying
draw: drew drawn
drink: drank drunk
drive: drove driven
eat: ate eaten
fall: fell fallen
feel: felt
fight: fought
find: found
fly: flew flown
foot: feet
forget: forgot forgotten
get: got gotten
give: gave given
go: goes went gone
good: better best
grow: grew grown
hear: heard
hold: held
keep: kept
knife: knives
know: knew known
lead: led
leave: left
lie: lies lying lain
life: lives
little: less least
lose: lost
make: made
man: men
mean: meant
meet: met
mouse: mice
pay: paid
person: people
ride: rode ridden
ring: rang rung
run: ran
say: said
see: saw seen
sell: sold
send: sent
shoe: shoes
show: shown
shrink: shrank shrunk
sing: sang sung
sit: sat
sleep: slept
speak: spoke spoken
spend: spent
stand: stood
steal: stole stolen
stick: stuck
swim: swam
take: took taken
teach: taught
tear: tore torn
tell: told
think: thought
throw: threw thrown
tooth: teeth
understand: understood
use: uses used using
wake: woke woken
wear: wore worn
wife: wives
win: won
woman: women
write: wrote written
"""

# Words that end like an inflected form but are not one.
_INVARIANT = """
always anything bring bed ceiling during everything evening feed gas king lens morning need news
nothing perhaps plus red ring seed series shed sing sometimes something speed spring string thing
thus unless wing yes
""".split()


def irregular_forms() -> dict[str, str]:
    """Form to lemma, invariant words mapped to themselves."""
    table = {word: word for word in _INVARIANT}
    for line in _IRREGULAR.strip().splitlines():
        lemma, forms = line.split(":")
        table.update({form: lemma for form in forms.split()})
    return table


# Suffix rules, first match wins: (ending, shortest word it applies to, characters cut, added).
PLURAL_RULES = [
    ("ies", 5, 3, "y"),
    ("sses", 5, 2, ""),
    ("shes", 5, 2, ""),
    ("ches", 5, 2, ""),
    ("xes", 4, 2, ""),
    ("ss", 1, 0, ""),
    ("us", 1, 0, ""),
    ("is", 1, 0, ""),
    ("s", 4, 1, ""),
    ("ied", 5, 3, "y"),
]
# Verb endings leave a stem that :func:`_restore` completes: (ending, shortest word).
VERB_RULES = [("ing", 6), ("ed", 5)]
# Stems with one of these endings lost a silent e.
SILENT_E = ("at", "bl", "iz", "v", "c", "u", "dg")
# Doubled final consonants other than these are reduced to one.
KEPT_DOUBLES = ("ll", "ss", "zz")


def _restore(stem: Column) -> Column:
    doubled = stem.rlike(r"([b-df-hj-np-tv-z])\1$") & ~F.substring(stem, -2, 2).isin(*KEPT_DOUBLES)
    silent = stem.rlike("(" + "|".join(SILENT_E) + ")$")
    return (
        F.when(doubled, F.left(stem, F.length(stem) - 1))
        .when(silent, F.concat(stem, F.lit("e")))
        .otherwise(stem)
    )


def lemma(word: Column, irregular: dict[str, str] | None = None) -> Column:
    """Dictionary form of one lower-case word: irregular list first, then suffix rules."""
    table = irregular_forms() if irregular is None else irregular
    ruled = word
    for ending, shortest in reversed(VERB_RULES):
        stem = F.left(word, F.length(word) - len(ending))
        applies = word.endswith(ending) & (F.length(word) >= shortest) & stem.rlike("[aeiouy]")
        ruled = F.when(applies, _restore(stem)).otherwise(ruled)
    for ending, shortest, cut, added in reversed(PLURAL_RULES):
        stem = F.concat(F.left(word, F.length(word) - cut), F.lit(added))
        ruled = F.when(word.endswith(ending) & (F.length(word) >= shortest), stem).otherwise(ruled)
    if not table:
        return ruled
    # isin() on literals probes a hash set; the map (a linear search) is read only after a hit.
    lookup = F.create_map(*[F.lit(x) for x in chain.from_iterable(table.items())])
    return F.when(word.isin(*table), F.element_at(lookup, word)).otherwise(ruled)


def lemmatize(
    cleaned: Column,
    stop_words: list[str] | None = None,
    irregular: dict[str, str] | None = None,
) -> Column:
    """Drop stop words and reduce the rest to dictionary forms, in order, within the row.

    A text made of stop words only comes back unchanged.
    """
    stops = CLEANED_STOP_WORDS if stop_words is None else stop_words
    words = F.filter(cleaned_words(cleaned), lambda w: ~w.isin(*stops) & (w != ""))
    joined = F.array_join(F.transform(words, lambda w: lemma(w, irregular)), " ")
    return F.coalesce(F.nullif(joined, F.lit("")), cleaned)  # nullif evaluates ``joined`` once
