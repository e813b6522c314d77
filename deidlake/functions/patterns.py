"""Detection patterns for free-text redaction and entity lexicons.

A pattern is an entity body plus the set of characters that must not
touch it on the left / right (its word class).  Two spellings are derived:

* Spark (Java regex): ``(?<![W])(body)(?![W])`` -- one pass, group 1 is
  the span, replacement ``<ENTITY>``.
* SQL oracle (RE2 has no look-around): ``(^|[^W])(body)([^W]|$)`` with
  boundaries consumed; two entities one character apart are found by a
  second pass, so the oracle runs two passes.  Bodies start and end with
  word characters, which makes both spellings replace the same spans.

Bodies avoid ``.`` and ``\\s`` (different line-terminator sets in the two
engines) and back-references.
"""

from __future__ import annotations

from dataclasses import dataclass


MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Built-in name lexicons (our own, deliberately small; pass a lexicon
# DataFrame/list for production use).  Recall is limited to these words.
PERSON_NAMES = (
    "Adam", "Alice", "Amelia", "Andrew", "Anna", "Charlotte", "Daniel", "David",
    "Elizabeth", "Emily", "Emma", "George", "Grace", "Harry", "Isabella", "Jack",
    "James", "Jane", "John", "Joseph", "Laura", "Lucy", "Maria", "Mary",
    "Michael", "Mohammed", "Noah", "Oliver", "Olivia", "Peter", "Robert", "Sarah",
    "Sophie", "Thomas", "William",
    "Brown", "Davies", "Evans", "Johnson", "Jones", "Miller", "Patel", "Roberts",
    "Smith", "Taylor", "Thompson", "Williams", "Wilson", "Wright",
)
LOCATIONS = (
    "Amsterdam", "Berlin", "Birmingham", "Bristol", "Cambridge", "Cardiff",
    "Dublin", "Edinburgh", "England", "France", "Germany", "Glasgow", "Leeds",
    "Liverpool", "London", "Madrid", "Manchester", "New York", "Oxford", "Paris",
    "Rome", "Scotland", "Spain", "United Kingdom", "Wales",
)

# Feature-extraction lexicon (term, label); terms are matched on lower-cased
# word tokens, so multi-word terms are single-space separated.
ENTITY_LEXICON = (
    ("paranoid schizophrenia", "DISEASE"),
    ("schizophrenia", "DISEASE"),
    ("bipolar disorder", "DISEASE"),
    ("depression", "DISEASE"),
    ("major depressive disorder", "DISEASE"),
    ("anxiety", "DISEASE"),
    ("psychosis", "DISEASE"),
    ("dementia", "DISEASE"),
    ("diabetes", "DISEASE"),
    ("type 2 diabetes", "DISEASE"),
    ("hypertension", "DISEASE"),
    ("asthma", "DISEASE"),
    ("epilepsy", "DISEASE"),
    ("insomnia", "DISEASE"),
    ("aripiprazole", "CHEMICAL"),
    ("olanzapine", "CHEMICAL"),
    ("risperidone", "CHEMICAL"),
    ("quetiapine", "CHEMICAL"),
    ("clozapine", "CHEMICAL"),
    ("haloperidol", "CHEMICAL"),
    ("lithium", "CHEMICAL"),
    ("lithium carbonate", "CHEMICAL"),
    ("sertraline", "CHEMICAL"),
    ("fluoxetine", "CHEMICAL"),
    ("diazepam", "CHEMICAL"),
    ("lorazepam", "CHEMICAL"),
    ("metformin", "CHEMICAL"),
    ("insulin", "CHEMICAL"),
    ("paracetamol", "CHEMICAL"),
    ("ibuprofen", "CHEMICAL"),
)


_META = set(".^$*+?()[]{}|\\")


def _escape(text: str) -> str:
    return "".join("\\" + ch if ch in _META else ch for ch in text)


def _alternation(words) -> str:
    """Alternation of ``words`` as a prefix trie: ``A(?:dam|n(?:na|drew))``.

    At each position the engine only follows words sharing the next
    character instead of trying every word.  Continuing a word is greedy
    (``(?:...)?``), so a longer word is preferred over its prefix -- the
    same choice as a longest-first alternation, in Java and in RE2."""
    trie: dict = {}
    for w in set(words):
        node = trie
        for ch in w:
            node = node.setdefault(ch, {})
        node[""] = {}

    def build(node) -> str:
        ends = "" in node
        branches = []
        for ch in sorted(k for k in node if k):
            branches.append(_escape(ch) + build(node[ch]))
        if not branches:
            return ""
        body = branches[0] if len(branches) == 1 else "(?:" + "|".join(branches) + ")"
        if ends:
            return f"(?:{body})?"
        return body

    return "(?:" + build(trie) + ")"


@dataclass(frozen=True)
class Pattern:
    entity: str
    body: str
    lead: str = ""   # characters that must not precede the body ("" = any)
    trail: str = ""  # characters that must not follow the body
    needles: tuple[str, ...] = ()  # every match contains one of these (cheap pre-check)
    # Java-only start hint: a look-around that rejects positions where no
    # match can start (one character test instead of trying the whole body);
    # it never changes which spans match
    start: str = ""

    @property
    def regex(self) -> str:
        """Java regex for Spark; group 1 is the span."""
        lead = f"(?<![{self.lead}])" if self.lead else ""
        trail = f"(?![{self.trail}])" if self.trail else ""
        return f"{self.start}{lead}({self.body}){trail}"

    @property
    def spark_replacement(self) -> str:
        return f"<{self.entity}>"

    @property
    def re2_regex(self) -> str:
        """RE2 spelling: three groups, consumed boundaries; group 2 is the span."""
        lead = f"^|[^{self.lead}]" if self.lead else ""
        trail = f"[^{self.trail}]|$" if self.trail else ""
        return f"({lead})({self.body})({trail})"

    @property
    def re2_replacement(self) -> str:
        return f"\\1<{self.entity}>\\3"

    @property
    def re2_passes(self) -> int:
        return 2 if (self.lead or self.trail) else 1


_WORD = r"\p{L}\p{N}_"
_ALNUM = "0-9A-Za-z"

# An e-mail found by leftmost search starts where its run of local-part
# characters starts, or right where the previous match ended (\G), so
# starting only there finds the same spans.
EMAIL = Pattern("EMAIL_ADDRESS", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}",
                needles=("@",), start=r"(?:\G|(?<![A-Za-z0-9._%+-]))")
URL = Pattern("URL", r"(?:[Hh][Tt][Tt][Pp][Ss]?://|www\.)[^ \t\n\r\f<>\"']+", needles=("://", "www."),
              start="(?=[Hhw])")
_month = _alternation(MONTHS)
DATE_TIME = Pattern(
    "DATE_TIME",
    "(?:"
    r"[0-9]{4}-[0-9]{2}-[0-9]{2}(?:[T ][0-9]{2}:[0-9]{2}(?::[0-9]{2})?)?"
    r"|[0-9]{1,2}/[0-9]{1,2}/[0-9]{2,4}"
    rf"|[0-9]{{1,2}}(?:st|nd|rd|th)? {_month} [0-9]{{4}}"
    rf"|{_month} [0-9]{{1,2}}(?:st|nd|rd|th)?,? [0-9]{{4}}"
    r"|[0-9]{1,2}:[0-9]{2}(?::[0-9]{2})?(?: ?[AaPp][Mm])?"
    ")",
    lead=_ALNUM,
    trail=_ALNUM,
    start="(?=[0-9A-S])",
)
PHONE = Pattern(
    "PHONE_NUMBER",
    "(?:"
    r"(?:\+?1[ .-]?)?(?:\([0-9]{3}\)|[0-9]{3})[ .-]?[0-9]{3}[ .-][0-9]{4}"
    r"|\+[0-9]{2,3}[ .-]?[0-9]{2,4}[ .-][0-9]{3,4}[ .-][0-9]{3,4}"
    ")",
    lead="0-9+",
    # a phone may start with '+' or '(': such a character right after
    # another phone must not be accepted as its end, else the one-pass and
    # two-pass spellings would disagree
    trail="0-9+(",
    start=r"(?=[0-9(+])",
)


def lexicon_pattern(entity: str, words, multiword: bool) -> Pattern:
    """Case-sensitive whole-word match of lexicon words; ``multiword`` joins
    adjacent words into one span ("John Smith" -> one PERSON)."""
    alt = _alternation(words)
    body = f"{alt}(?: {alt})*" if multiword else alt
    firsts = "".join(sorted({_escape(w[0]) for w in words}))
    return Pattern(entity, body, lead=_WORD, trail=_WORD, start=f"(?=[{firsts}])")


PERSON = lexicon_pattern("PERSON", PERSON_NAMES, multiword=True)
LOCATION = lexicon_pattern("LOCATION", LOCATIONS, multiword=False)

# Application order: e-mail before URL (domains), dates before phones
# (digit runs), names last.
DEFAULT_PATTERNS = (EMAIL, URL, DATE_TIME, PHONE, PERSON, LOCATION)


def patterns_for(entities) -> tuple[Pattern, ...]:
    wanted = set(entities)
    unknown = wanted - {p.entity for p in DEFAULT_PATTERNS}
    if unknown:
        raise ValueError(f"no detector for entities {sorted(unknown)}")
    return tuple(p for p in DEFAULT_PATTERNS if p.entity in wanted)


# Word tokenizer shared by entity extraction (Spark) and its SQL oracle.
TOKEN_SPLIT = r"[^\p{L}\p{N}]+"
