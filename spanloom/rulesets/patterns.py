"""Shared parts of the rule patterns.

Tokens are separated by optional blanks; a newline between them ends a match.
"""

S = r"[ \t]*"
B, E = r"(?<![\p{L}\p{N}])", r"(?![\p{L}\p{N}])"
NB, NE = r"(?<!\p{N})", r"(?!\p{N})"

# Days, months, years, words that announce a date, units that a number can have.
DAY = r"(?:[12][0-9]|30|31|0?[1-9])"
MONTH = r"(?:1[0-2]|0?[1-9])"
YEAR4, YEAR2 = r"(?:19[0-9]{2}|20[0-2][0-9])", r"(?:9[0-9]|[0-2][0-9])"
YEAR = rf"(?:{YEAR4}|{YEAR2}){NE}"
MONTHS_DE = ("Januar", "Februar", "März", "April", "Mai", "Juni", "Juli", "August", "September", "Oktober", "November", "Dezember")
MONTHS_EN = ("January", "February", "March", "April", "May", "June", "July", "August", "September", "October", "November", "December")
MONTHS_SHORT = ("Jan", "Feb", "Mär", "Apr", "Mai", "Jun", "Jul", "Aug", "Sept", "Sep", "Okt", "Nov", "Dez")
_long = sorted({w for m in MONTHS_DE + MONTHS_EN for w in (m, m.upper(), m.lower())}, key=lambda w: (-len(w), w))
MONTH_NAME = rf"(?:{'|'.join(_long)}|(?:{'|'.join(MONTHS_SHORT)})\.?)(?!\p{{L}})"
TRIGGER = rf"{B}(?:am|ab|bis|den|dem|seit|vom|Erstdiagnose|E[DMS]|Aufenthalt){E}"
UNIT = r"(?:mg|min|mm|cm|mmol|Grad|Pkt|%|mml|mmHg|s|Punkte|Punkten|Pkt|Pkte|Glomeruli|Glomerula|IE|Jahren|J|E/ml)(?!\p{L})"
RANGE = r"(?:-|und|bis|\+)"

# Salutations, titles, roles.
CIVIL = r"(?:Herrn|Herr|Hr\.?|Frau|Fr\.?|Ehepaar|Familie)"
TITLE = r"(?:Prof\.?|PD|Dr\.?(?:[ \t]*med\.?)?|Professor|pract\.)"
ROLE = r"(?:OA|AA|UA|OÄ|AÄ|JA)"
CAP = r"\p{Lu}\p{Ll}+"
CAPS = r"\p{Lu}{2,}"
