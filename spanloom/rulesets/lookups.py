"""Rules that combine lexicon labels: patterns over strings of token classes (one letter a token).

Each set has its own letters, given in ``spanloom.operators.lookup_rules``.
"""

from spanloom.operators.rules import Rule

OCC = "Occupation"
WORKPLACE = "(be?)?(C{1,2})?"
ANY_OCC, IN_ANAMNESIS = "[QOo]", "[QO]"

#: Q occupation in an occupation context of an anamnesis, O in an anamnesis, o elsewhere, E employer in an anamnesis,
#: a words that announce one, s seit, b and e what leads to a workplace, C capitalised, N newline, marks as themselves.
OCCUPATIONS = [
    Rule("OccupationsFromGazetteerAnamnesisSentenceStart", rf"(\.)({IN_ANAMNESIS}+)", ((2, OCC, ""),)),
    Rule("OccupationsFromGazetteerInOccupationContext", rf"()(Q+){WORKPLACE}", ((2, OCC, ""), (4, OCC, ""))),
    Rule("OccupationsFromGazetteerLeftTrigger", rf"(a|s.{{1,2}})({ANY_OCC}+){WORKPLACE}", ((2, OCC, ""), (4, OCC, ""))),
    Rule("OccupationsFromGazetteerParenthesis", rf"(\()({IN_ANAMNESIS}+)(\))", ((2, OCC, ""),)),
    Rule("EmployerFromGazetter", r"()(E+)", ((2, OCC, ""),)),
]
OCCUPATION_STARTS = [Rule("OccupationsFromGazetteerAnamnesisSentenceAnnotationStart", rf"(^|[.N!?])({IN_ANAMNESIS}+){WORKPLACE}", ((2, OCC, ""), (4, OCC, "")))]

LOC = "Location"
#: Y city, T street, K short name of a canton, Z what a zip code looks like, c CH, n other numbers, i a single letter,
#: P in a place found before, M in a name found before, marks as themselves.
CITIES = [Rule("CityAndCanton", r"()(Y{1,3}[(,/]?K\)?)", ((2, LOC, "city"),))]
ZIPS = [Rule("ZipCodes", r"(c?)(-?)(Z)(,?Y)", ((1, LOC, "country"), (3, LOC, "zip")))]
STREETS = [Rule("StreetNamesFromGazetteer", r"()(T+(?:ni?)?)", ((2, LOC, "street"),))]
CANTONS = [
    Rule("AddCantonAbbrev", r"()([PYT][PYTni]*K)", ((2, LOC, "other"),)),
    Rule("AddCantonAbbrevName", r"(M,)(K)", ((2, LOC, "other"),)),
]

#: X first name in a name context.
NAMES_IN_CONTEXT = [Rule("SingleNameOrSurnameInNameContext", r"()(X+)", ((2, "Name", "other"),))]
