"""Names by lexicon: patterns over strings of token classes (one letter a token)."""

from spanloom.operators.rules import Rule

FIRST, LAST, ANY = "[FB]", "[SB]", "[FSBC]"
#: Parts that a name has at most where what follows could be one of them too: a list of any length is cut there, and no loop goes deep.
PARTS = 20
PREP = "p{0,2}"
INITIAL = r"(?:I\.-?)"
OTHER = ((2, "Name", "other"),)

RULES = [
    Rule("DoctorsLeftContext", rf"((?:H\.?)?(?:(?:D\.?)++|R))({INITIAL}{{0,2}}{ANY}(?:-?{PREP}{ANY}){{0,5}})", ((2, "Name", "doctor"),), 100),
    Rule("StaffSurnameEnumeration", rf"()({LAST})(/)({LAST})(/)?({LAST})?", ((2, "Name", "medical staff"), (4, "Name", "medical staff"), (6, "Name", "medical staff"))),
    Rule("FirstNameLastNameFromGazetteers", rf"()({FIRST}(?:-?{FIRST}){{0,{PARTS}}}{INITIAL}{{0,2}}{PREP}{LAST}(?:-?{LAST})*+)", OTHER),
    Rule("FirstNameLastNameUpper", rf"()({FIRST}+{PREP}U(?:[-p]*+U)*+)", OTHER),
    Rule("LastNameFirstNameFromGazetteers", rf"()({LAST}(?:-?{ANY}){{0,{PARTS}}},?{FIRST}+)", OTHER),
    Rule("UpperLastNameFirstNameFromGazetteers", rf"()(U(?:[-p]*+U)*+,?{FIRST}+)", OTHER, 100),
    Rule("ShortNameWithGazetteer", rf"()({INITIAL}{{1,2}}{PREP}{LAST}+)", OTHER, 200),
    Rule("NameOutOfVoc", rf"()({FIRST}C+)", OTHER),
    Rule("UniqueNameOrSurname", r"()([FSB]+)", OTHER, 0),
    Rule("UniqueDoubleName", r"()([FSB]-[FSB])", OTHER, 0),
    Rule("UniqueDoubleNameNegative1", r"(.-M)", (), 100),
    Rule("UniqueDoubleNameNegative2", r"(M-.)", (), 100),
    Rule("SimpleDetectPatient", rf"(H\.?)((?:{INITIAL}{{0,2}}{ANY}(?:-?{PREP}{ANY}){{0,5}})|I\.)", ((2, "Name", "patient"),), 0),
    Rule("DoubleNameLeftTriggered", r"([HD]\.?)([CFSB]-[CFSB]|C[FSB])", ((2, "Name", "patient"),)),
    Rule("FirstNameInSalutation", r"(L)([FB](?:-?[FB])*+)", OTHER, 100),
    Rule("ConsumeMethodSingleAuthor", r"(w[SB])", (), 1000),
    Rule("ConsumeMethodAuthors", rf"({LAST}&{LAST}(?:,n)?)", (), 1000),
]
