"""A letter model of ordinary strings, fitted on the corpus that is scanned.

Each symbol depends on the one before it, as it does in the corpus's own short words, whatever their
language or kind. Where the corpus has seen little, a fixed model counts like ``PRIOR`` pairs after
each symbol: the kind of the next symbol (lower, upper, digit, separator) follows fixed shares, a
letter inside a word the letter pairs of ``SAMPLE``, and a letter that begins a word the beginnings
of its words. Digits and separators are even. The model is a probability distribution over all
strings of ``SYMBOLS`` of one length.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Mapping

_LOWER, _UPPER = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS, SEPARATORS = "0123456789", "+/_-"
#: All digits count as 0 and all separators as -.
SYMBOLS = _LOWER + _UPPER + "0-"
#: Pairs after each symbol that the fixed model counts like.
PRIOR = 1000.0
#: Different characters that a symbol stands for.
_MEMBERS = {"0": len(DIGITS), "-": len(SEPARATORS)}
#: Weight of the single letters' shares in those of pairs and beginnings.
WEIGHT = 6.0

#: Share of the next symbol's kind (lower, upper, digit, separator) by the kind of the one before.
_NEXT = {
    "start": (0.6, 0.3, 0.07, 0.03),
    "lower": (0.92, 0.03, 0.02, 0.03),
    "upper": (0.37, 0.55, 0.04, 0.04),
    "digit": (0.25, 0.15, 0.35, 0.25),
    "separator": (0.6, 0.2, 0.15, 0.05),
}
_KINDS = ("lower", "upper", "digit", "separator")

SAMPLE = """
all human beings are born free and equal in dignity and rights they are endowed with reason and
conscience and should act towards one another in a spirit of brotherhood everyone has the right to
life liberty and security of person no one shall be held in slavery or servitude the quick
development of information technology has changed how people communicate international organisations
counterbalance environmental responsibilities which government departments usually characterise
through administrative recommendations knowledge happens question just example very vowels jacket
zone
alle menschen sind frei und gleich an wuerde und rechten geboren sie sind mit vernunft und gewissen
begabt und sollen einander im geiste der bruederlichkeit begegnen jeder hat das recht auf leben
freiheit und sicherheit der person niemand darf in sklaverei oder leibeigenschaft gehalten werden
die wissenschaftliche zusammenarbeit zwischen verschiedenen gesellschaften und versicherungen
erfordert gegenseitige verantwortlichkeit sowie selbstverstaendlich schwierige entscheidungen kopf
zukunft bequem jahr typ
tous les etres humains naissent libres et egaux en dignite et en droits ils sont doues de raison et
de conscience et doivent agir les uns envers les autres dans un esprit de fraternite tout individu a
droit a la vie a la liberte et a la surete de sa personne nul ne sera tenu en esclavage quelquefois
les gouvernements developpent heureusement des recommandations administratives nouvelles pour
ameliorer le fonctionnement beaucoup jamais chaque voyage oiseaux
todos los seres humanos nacen libres e iguales en dignidad y derechos y dotados como estan de razon
y conciencia deben comportarse fraternalmente los unos con los otros todo individuo tiene derecho a
la vida a la libertad y a la seguridad de su persona nadie estara sometido a esclavitud los
acontecimientos internacionales generalmente requieren responsabilidad y cooperacion entre las
organizaciones publicas aquello ejemplo hijo excelente
"""


def _kind(symbol: str) -> str:
    return _KINDS[0 if symbol in _LOWER else 1 if symbol in _UPPER else 2 if symbol == "0" else 3]


def surprise(pairs: Mapping[str, int] | None = None) -> list[float]:
    """Bits of a symbol after another: row 0 for the first symbol, then one row per ``SYMBOLS``.

    ``pairs`` counts neighbours in the corpus's words, the first letter of a word after a space.
    """
    words = SAMPLE.split()
    letters, begins = Counter("".join(words)), Counter(w[0] for w in words)
    pairs_of = Counter(a + b for w in words for a, b in zip(w, w[1:]))
    single = {c: (letters[c] + 1) / (letters.total() + len(_LOWER)) for c in _LOWER}

    def begin(c: str) -> float:
        return (begins[c] + WEIGHT * single[c]) / (len(words) + WEIGHT)

    after = {a: sum(pairs_of[a + c] for c in _LOWER) for a in _LOWER}

    def share(before: str, symbol: str) -> float:
        """Share of the symbol, with all characters that it stands for."""
        old, new = _kind(before) if before else "start", _kind(symbol)
        kind = _NEXT[old][_KINDS.index(new)]
        if new in ("digit", "separator"):
            return kind
        a, b = before.lower(), symbol.lower()
        if old in ("start", "digit", "separator") or (old, new) == ("lower", "upper"):
            return kind * begin(b)
        return kind * (pairs_of[a + b] + WEIGHT * single[b]) / (after[a] + WEIGHT)

    found, out = pairs or {}, []
    for a in ("", *SYMBOLS):
        seen = [found.get((a or " ") + b, 0) for b in SYMBOLS]
        total = sum(seen) + PRIOR
        for b, n in zip(SYMBOLS, seen):
            out.append(-math.log2((n + PRIOR * share(a, b)) / total / _MEMBERS.get(b, 1)))
    return out
