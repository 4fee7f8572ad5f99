"""Ages, contacts, identifiers, places, occupations and names that need no lexicon."""

from spanloom.operators.rules import DIGIT, Rule, needing
from spanloom.rulesets.patterns import CAP, CAPS, CIVIL, NB, NE, ROLE, TITLE, B, E, S

AGE_N = rf"{NB}(?:1[0-2][0-9]|[0-9]{{1,2}})(?:\.[0-9]+)?"
AGE = [
    Rule("AgeRightContextTrigger", rf"()({AGE_N})({S}(?:-?{S}jährige?[rnm]?|-?{S}[jJ]\.?(?!\p{{L}})(?={S}(?:Patient|gestorben|verstorben))|-{S}[jJ]|Jahre{S}alte?[rn]?|(?:Jahren{S}|J\.?{S})?(?:gestorben|verstorben))(?!\p{{L}}))", ((2, "Age", ""),)),
    Rule("AgeLeftContextTrigger", rf"({B}Alter{S}[^\p{{L}}\p{{N}}\s]?{S})({AGE_N})(?![0-9])", ((2, "Age", ""),)),
    Rule("AgeLeftRightContext", rf"({B}(?:[Mm]it|[Ii]m{S}Alter{S}von){S})({AGE_N})({S}(?:Jahren|[Jj])\.?(?!\p{{L}}))", ((2, "Age", ""),)),
    Rule("AgeYearOfLife", rf"({B}(?:[Ss]eit|[Nn]ach){S}dem{S})({AGE_N})({S}\.?{S}Lebensjahr)", ((2, "Age", ""),)),
    Rule("KidsAge", rf"({B}Kinder{S}\({S})({AGE_N})({S}[jJ]?{S}(?:,{S})?)({AGE_N})?({S}[jJ]?{S}(?:,{S})?)({AGE_N})?({S}[jJ]?{S}\))", ((2, "Age", ""), (4, "Age", ""), (6, "Age", "")), 100),
]

TLD = r"(?:info|com|net|org|ch|de|fr|li|eu)"
# Loops over groups are possessive or bounded: Java's matcher goes one call deeper at each turn of any other, and a long list would end the JVM.
# A run of letters and digits can only begin a match at its own start, or a long one would be tried from each of its places.
HOST = r"[A-Za-z0-9]++(?:-[A-Za-z0-9]++)*+"
RUN, MAIL_RUN = r"(?<![A-Za-z0-9])(?<![A-Za-z0-9]-)", r"(?<![A-Za-z0-9])(?<![A-Za-z0-9][._])"
LABELS = 32
INTERNET = [
    Rule("emailaddress", rf"()({MAIL_RUN}[A-Za-z0-9]++(?:[._][A-Za-z0-9]++)*+@(?:{HOST}\.){{1,{LABELS}}}{TLD}\b)", ((2, "Contact", "email"),)),
    Rule("url", rf"()({RUN}(?:(?:https?|ftp)://)?(?:{HOST}\.){{2,{LABELS}}}{TLD}\b(?:/[A-Za-z0-9_./-]*[A-Za-z0-9_/])?)", ((2, "Contact", "website"),)),
]

SEP = r"[ \t]*(?:[-/][ \t]*)?"
BLOCKS = rf"(?:[0-9]{{3}}{SEP}[0-9]{{2}}{SEP}[0-9]{{2}}|[0-9]{{2}}{SEP}[0-9]{{2}}{SEP}[0-9]{{2}}|[0-9]{{3}}{SEP}[0-9]{{4}}|[0-9]{{4}}{SEP}[0-9]{{3}}|[0-9]{{3}}{SEP}[0-9]{{3}}|[0-9]{{7}})"
CONTACTS = [
    Rule("SwissNumber", rf"()((?<![0-9+])(?:(?:0041|\+[ \t]?41){S}(?:\({S}0{S}\){S})?[0-9]{{2}}|0[0-9]{{2,3}}){SEP}{BLOCKS}(?!{SEP}[0-9]))", ((2, "Contact", "phone number"),), 100),
    Rule("SwissNumberNoSpaces", rf"()((?<![0-9+])(?:0[0-9]{{9}}|(?:0041|\+41)[0-9]{{9,10}}){NE})", ((2, "Contact", "phone number"),)),
    Rule("InternationalNumber", rf"()((?<![0-9])(?:\+[ \t]?[1-9][0-9]{{0,2}}|00[1-9][0-9]{{0,2}})(?:[ \t]+[0-9]+){{3,7}}{NE})", ((2, "Contact", "phone number"),)),
    Rule("PhoneNumberLeftTrigger", rf"({B}(?:Tel|Fax|Telefax|Sekretariat){S}\.?{S}-?{S}(?:Nr)?\.?{S}:?{S})(\+?[0-9(][0-9()/ \t-]*[0-9])", ((2, "Contact", "phone number"),)),
    Rule("NorthAmericanNumber", r"()(\([0-9]{3}\) [0-9]{3}-[0-9]{4})", ((2, "Contact", "phone number"),)),
    Rule("NetworkAddress", rf"()({NB}[0-9]{{1,3}}(?:\.[0-9]{{1,3}}){{3}}{NE})", ((2, "Contact", "website"),)),
]

#: A shorter list of numbers, for first steps with rules.
SIMPLE_CONTACTS = [
    Rule("SwissNumberSimplified", rf"()({NB}0[1-9][0-9]{{1,2}}{S}-?{S}(?:[0-9]{{3}}{S}-?{S}[0-9]{{2}}{S}-?{S}[0-9]{{2}}|[0-9]{{3}}{S}-?{S}[0-9]{{4}}){NE})", ((2, "Contact", "phone number"),)),
]

IDS = [
    Rule("PatnrTrigger", rf"({B}PatNr{S}[^\p{{L}}\p{{N}}\s]?{S})([0-9]+)", ((2, "ID", "patient ID"),)),
    Rule("PatientIDVerlauf", rf"(#{S})([0-9]{{5,8}}){NE}", ((2, "ID", "patient ID"),), context="Verlauf"),
    Rule("CaseIDVerlauf", rf"({B}Fall{S})([0-9]+)", ((2, "ID", "case ID"),), context="Verlauf"),
    Rule("PatientIDPatInfo", rf"()({NB}[0-9]{{5,8}}{NE})", ((2, "ID", "patient ID"),), context="PatInfo"),
    Rule("VariousIDsLeftTriggered", rf"({B}(?:Aggregatwechsel|S/N|Serien-Nr|SNr|SN|Seriennummer){S}\.?{S}:?{S})((?:\p{{Lu}}+{S})?[0-9]+(?:\p{{Lu}}{E})?)", ((2, "ID", "other"),)),
    Rule("AHVNumber", rf"()({NB}756{S}\.{S}[0-9]{{4}}{S}\.{S}[0-9]{{4}}{S}\.{S}[0-9]{{2}}{NE})", ((2, "ID", "social security number"),)),
    Rule("LeftTriggeredID", rf"()({B}\p{{Lu}}{S}[0-9]{{3}}{S}[.-]{S}[0-9]{{3}}(?:[0-9]{{2}})?{NE})", ((2, "ID", "other"),)),
    Rule("CardNumber", rf"()({NB}[0-9]{{16}}{NE})", ((2, "ID", "other"),)),
]

# Words that name a practice, a home or a clinic.
INSTITUTION = (
    "Hausärzte", "Ärztehaus", "Aerztehaus", "Arzthaus", "Permanence", "Ärztezentrum", "Aerztezentrum", "Homecare", "Sozialzentrum", "Altersheim", "Altenheim", "Altersresidenz", "Alterssiedlung", "Alterswohnheim", "Alterszentrum", "Heim", "Pflegheim", "Pflegeheim",
    "Pflegewohngruppe", "Pflegzentrum", "Pflegezentrum", "Residenz", "Seniorenheim", "Seniorenzentrum", "Übergangspflegheim", "Übergangspflegeheim", "APH", "PZ", "Praxisgemeinschaft", "Beratungsstelle", "Salem", "Spitex", "Tertianum", "Klinik", "Kliniken", "Klinikum", "Rehabilitationsklinik", "Sanatorium", "RehaZentrum", "Zentrum",
)
# Roles of those who address a letter.
ADDRESSOR = r"(?:Direktor(?:in)?|Koordinator(?:in)?|\p{L}*[Mm]anager(?:in)?|Leit[a-z]+|\p{L}?[Ss]pezialist(?:in)?)(?!\p{L})"

NUMBER = rf"(?:{S}[0-9]+[a-zA-Z]?{E})?"
LOCATIONS = [
    Rule("LocationLeftTrigger", rf"({B}Haltestelle{S})({CAP}(?:[ -]{CAP})*+)", ((2, "Location", "other"),)),
    Rule("GenericStreetNames", rf"()({B}\p{{Lu}}\p{{L}}*(?:allee|gasse|platz|strasse|weg|str\.?)(?!\p{{L}}){NUMBER})", ((2, "Location", "street"),)),
    Rule("GenericStreetNamesLeftTrigger", rf"()({B}(?:Rue|Via){S}(?:(?:des|du|la){S})?{CAP}(?:{S}{CAP})*+{NUMBER})", ((2, "Location", "street"),)),
    Rule("StreetsNamedAfterPeople", rf"()({B}{CAP}(?:{S}-{S}(?!(?:Strasse|Str)(?!\p{{L}})){CAP})*+{S}-?{S}(?:Strasse|Str\.?)(?!\p{{L}}){NUMBER})", ((2, "Location", "street"),)),
    Rule("PostalBox", rf"()({B}Postfach(?:{S}[0-9]+)?)", ((2, "Location", "street"),)),
    Rule("ZipCodeAndCityWithCountry", rf"()({B}[A-Z]{{1,2}})({S}-{S})([1-9][0-9]{{3,}})({S})({CAP})?", ((2, "Location", "country"), (4, "Location", "zip"), (6, "Location", "city"))),
    Rule("HospitalLocation", rf"()({B}(?:\p{{L}}*[sS]pital|Reha|Krankenhaus|KS|RS){S}(?:St\.{S})?{CAP})", ((2, "Location", "organisation"),)),
    Rule("HospitalPostfix", rf"()({B}\p{{L}}+spitals?(?!\p{{L}}))", ((2, "Location", "organisation"),)),
    Rule("HospitalUnit", rf"()({B}(?:Klinik|Institut|Zentrum|Abteilung)(?:{S}und{S}Poliklinik)?{S}für{S}{CAP}(?:{S}{CAP})?(?:{S}(?:,|und){S}{CAP}(?:{S}{CAP})?)*+)", ((2, "Location", "organisational unit"),)),
    Rule("HospitalUnitRightTriggered", rf"()({B}\p{{L}}+ologische{S}Klinik{E})", ((2, "Location", "organisational unit"),)),
    Rule("HospitalUnitPostfix", rf"()({B}(?:Universitäre[sn]?{S})?\p{{Lu}}\p{{Ll}}+(?:klinik|institut|zentrums?|departement)(?!\p{{L}})(?:{S}{CAP})?)", ((2, "Location", "organisational unit"),)),
    Rule("HealthcareOrSocialInstitutions", rf"()({B}(?:\p{{L}}*[Pp]raxis|(?:Alters{S}-{S})?(?:{'|'.join(INSTITUTION)})s?){S}(?:[^\p{{L}}\p{{N}}\s.,:]{S})?(?:(?:am|im){S})?(?:{CAP}|&)(?:{S}(?:{CAP}|&))*+(?:{S}AG{E})?\"?)", ((2, "Location", "organisation"),)),
    Rule("HealthcareOrSocialInstitutionsRightTriggered", rf"()({B}\p{{Lu}}\p{{Ll}}+(?:[Pp]raxis|{S}-{S}(?:Praxis|Klinik|Rehaklinik|Wohnheim|Ärztezentrum))(?!\p{{L}}))", ((2, "Location", "organisation"),)),
    Rule("CompanyLeftTriggered", rf"({B}Firma{S})({CAP})", ((2, "Location", "organisation"),)),
    Rule("Foundations", rf"()({B}Stiftung{S}{CAP}(?:{S}{CAP}){{0,2}})", ((2, "Location", "organisation"),)),
    Rule("FoundationsRightTriggered", rf"()({B}{CAP}(?:{S}-?{S}{CAP}){{0,2}}{S}-?{S}Stiftung{E}|{B}\p{{Lu}}\p{{Ll}}+stiftung(?:{S}{CAP})?)", ((2, "Location", "organisation"),)),
    Rule("DetectLanguages", rf"()({B}(?:Schweizerdeutsche?|\p{{L}}+sprachige?[rnm]?)(?!\p{{L}}))", ((2, "Location", "geographical adjective"),)),
    Rule("ConsumeKlinik", rf"()({B}\p{{Lu}}\p{{Ll}}*klinik)({S}\p{{Ll}}+)"),
]

BUILDINGS = [
    Rule("FindBuilding", rf"()({B}(?:Station{S})?NORD{S}[12](?:{S}\p{{Lu}}{E})?(?:{S}Saal)?(?:{S}[0-9]+)?)", ((2, "Location", "street"),)),
    Rule("Stations", rf"()({B}Station{S}\p{{Lu}}+(?:{S}\p{{Lu}}+){{0,2}}(?!\p{{L}})(?:{S}[0-9]+)?)", ((2, "Location", "street"),)),
    Rule("Rooms", rf"()({B}Zimmer{S}[0-9]+)", ((2, "Location", "room"),)),
    Rule("Floor", rf"()({B}Stockwerk{S}\p{{L}}{E})", ((2, "Location", "other"),)),
    Rule("AnnotateZH", rf"()({B}ZH{E})", ((2, "Location", "region"),)),
]

PLACE = rf"(?:{S}(?:bei|im|für|in){S}(?:(?:der|einer|einem){S})?)"
TWO = ((2, "Occupation", ""), (4, "Occupation", ""))
OCCUPATIONS = [
    Rule("OccupationsLeftTriggered", rf"({B}(?:von{S}Beruf|Beruf{S}:|gelernte[r]?|(?:Lehre|Ausbildung){S}(?:als|:)){S})({CAP})({PLACE}?)({CAP})?", TWO),
    Rule("OccupationsRetiredLeftTriggered", rf"()({B}pensionierte[rn]?{S}{CAP})", ((2, "Occupation", ""),)),
    Rule("OccupationsWorkTriggered", rf"({B}(?:arbeitet|vormaliger?){S}(?:(?:weiterhin|als|bei|im|in|für|der|die|einer|einem){S})*+)((?!Patient)(?:{CAP}|{CAPS})(?:{S}(?:{CAP}|{CAPS}))*+)", ((2, "Occupation", ""),)),
    Rule("OccupationsLeftTriggeredAnamnesis", rf"({B}ehemals{S})({CAP})", ((2, "Occupation", ""),), context="AnamnesisField"),
    Rule("OccupationsRightTriggered", rf"({B}(?:als|in|im|bei|der|die|einer){S})((?!Patient){CAP}(?:{S}{CAP})*+)({S}(?:arbeitstätig|tätig|gearbeitet){E})", ((2, "Occupation", ""),)),
    Rule("OccupationPostfixTriggered", rf"()({B}\p{{Lu}}\p{{Ll}}*(?:ftler|ftlerin|professor|professorin|lehrer|lehrerin|studium|student|studentin|-Student|-Studentin|angestellter?)(?!\p{{L}}))", ((2, "Occupation", ""),)),
]

NAME = rf"{CAP}(?:{S}-{S}{CAP})?"
INITIALS = rf"(?:\p{{Lu}}\p{{Ll}}?\.{S}-?{S}){{1,2}}"
NAMES = [
    Rule("DoctorsLeftContext", rf"((?:{B}{CIVIL}{S})?{B}(?:(?:{TITLE}|{ROLE})(?!\p{{Ll}}){S})++)((?:{INITIALS})?{NAME}(?:{S}{NAME}){{0,2}})", ((1, "Salutation", ""), (2, "Name", "doctor")), 100),
    Rule("DoctorsRightContext", rf"((?:{B}{CIVIL}{S})?)({B}(?:{INITIALS})?{NAME}(?:{S}{NAME})?)({S},{S}(?:Oberarzt|Oberärztin|Assistenzarzt|Assistenzärztin|Chefarzt|Chefärztin|OA){E})", ((2, "Name", "doctor"),)),
    Rule("NursingStaffLeftContext", rf"({B}PFF{S})({NAME}(?:{S}{NAME})?)", ((2, "Name", "medical staff"),)),
    Rule("NursingStaffRightContext", rf"()({B}(?:{INITIALS})?{NAME}(?:{S}{NAME})?)({S},?{S}(?:Pflegefachfrau|Pflegefachmann|dipl|PFF|MPA)(?!\p{{L}}))", ((2, "Name", "medical staff"),)),
    Rule("StaffSurnameEnumerationTriggered", rf"({B}Anwesende?{S}:?{S})({NAME})({S}[,/]{S})({NAME})({S}[,/]{S})?({NAME})?", ((2, "Name", "medical staff"), (4, "Name", "medical staff"), (6, "Name", "medical staff"))),
    Rule("SimpleDetectPatient", rf"({B}{CIVIL}{S})((?!(?:Kollege|Kollegin|Anfang|Mitte|Ende|Dr|Prof)(?!\p{{L}}))(?:{INITIALS})?{NAME}(?:{S}{NAME}){{0,5}}|\p{{Lu}}\.)", ((1, "Salutation", ""), (2, "Name", "patient")), 0),
    Rule("ShortName", rf"()((?<![\p{{L}}\p{{N}}.])(?!Dr\.|Hr\.|Fr\.|St\.|Hd\.){INITIALS}{NAME})", ((2, "Name", "other"),)),
    Rule("ConsumeMethodAuthorsLeftTrigger", rf"({B}nach{S}{CAP}{S}(?:und|&){S}{CAP}(?:{S},{S}[0-9]{{4}})?)", (), 1000),
    Rule("ConsumeMethodAuthorsRightTrigger", rf"({B}{CAP}{S}(?:und|&){S}{CAP}{S},{S}[0-9]{{4}})", (), 1000),
    Rule("ConsumeBrand", rf"({B}{CAP}{S}I{{1,3}}{E})", (), 1000),
    Rule("ConsumeCitations", rf"({B}{CAP}(?:{S}{CAP})?{S}et{S}al{E})", (), 1000),
]

FIELDS = [
    Rule("VisDatProcessing", r"()(\p{L}+)", ((2, "Name", "medical staff"),), context="VisDat"),
    Rule("AgeFieldProcessing", rf"()({AGE_N})", ((2, "Age", ""),), context="AgeField"),
    Rule("AgeInPatientField", rf"()({AGE_N})({S}Jahre{E})", ((2, "Age", ""),), context="Patienteninformation"),
    Rule("CopyAddressRule", r"()([\s\S]+)", ((2, "Address", "other"),), context="AddressField"),
    Rule("AnnotateLocationDateField", rf"()({B}{CAP})({S},{S}(?:den{S})?)([\p{{N}}.]+)({S}/{S})?(\p{{Lu}}{{2,4}}{E})?", ((2, "Location", "city"), (4, "Date", "other"), (6, "Name", "medical staff")), context="LocationDateField"),
    Rule("ProcessOrtDat", rf"()({B}{CAP})({S},{S})([0-9.]+)({S}/?{S})(\p{{L}}{{2,5}}{E})({S}/{S})?(\p{{L}}{{2,5}}{E})?", ((2, "Location", "city"), (4, "Date", "other"), (6, "Name", "medical staff"), (8, "Name", "medical staff")), context="OrtDat"),
    Rule("InternalPhoneTrigger", rf"({B}(?:Tel\.?{S}Büro|Sucher){S}[^\p{{L}}\p{{N}}\s]?{S})([0-9]+(?:{S}[0-9]+)?)", ((2, "Contact", "phone number"),)),
    Rule("DOBTrigger", rf"({B}geb{S}\.?{S})({NB}[0-9]{{1,2}}\.[0-9]{{1,2}}\.[0-9]{{2,4}}{NE})", ((2, "Date", "DOB"),)),
    Rule("NamesInDisplayName", rf"()({B}(?:{INITIALS})?{NAME}(?:{S}{NAME})*+)", ((2, "Name", "medical staff"),), context="DisplayName"),
    Rule("ExtractNameFromPatName", rf"()({B}(?:{NAME}|{CAPS})(?:{S},?{S}(?:{NAME}|{CAPS})){{0,6}})", ((2, "Name", "patient"),), context="PatName"),
    Rule("DetectSignatures", rf"()({B}\p{{Lu}}{{3,8}}{E})", ((2, "Name", "medical staff"),), context="FieldWithSignature"),
    Rule("DetectSignaturesInTags", r"(<)(\p{Lu}{3})(>)", ((2, "Name", "medical staff"),)),
    Rule("HospitalUnitInAddress", rf"()({B}(?:Interdisziplinäres{S})?(?:Klinik|Institut|Zentrum)(?:{S}\p{{L}}+){{0,8}})", ((2, "Location", "organisational unit"),), context="FieldWithAddress"),
    Rule("ProcessDateSmallCapsSignField", rf"()({NB}[0-9]{{1,2}}\.[0-9]{{1,2}}(?:\.[0-9]{{2,4}})?)({S}[,/]?{S})({B}(?:\p{{Ll}}{{4,7}}|\p{{Lu}}{{4,7}}){E})", ((2, "Date", "other"), (4, "Name", "medical staff")), context="DateSmallCapsSignField"),
    Rule("ProcessDateSmallCapsSignFieldInv", rf"()({B}(?:\p{{Ll}}{{4,7}}|\p{{Lu}}{{4,7}}){E})({S}[,/]?{S})({NB}[0-9]{{1,2}}\.[0-9]{{1,2}}(?:\.[0-9]{{2,4}})?)", ((2, "Name", "medical staff"), (4, "Date", "other")), context="DateSmallCapsSignField"),
    Rule("ProcessSignatureSmallCapsEndSentenceField", rf"(\({S})?({B}\p{{Ll}}{{5}}{E})({S}\)?{S}\r?\n)", ((2, "Name", "medical staff"),), context="SignatureSmallCapsEndSentenceField"),
    Rule("AnnotateNamesInAddressor", rf"((?:^|\n){S})({CAP}(?:{S}{CAP})*+)({S}\r?\n(?:[^\n]*[^\p{{L}}\n])?{ADDRESSOR})", ((2, "Name", "other"),), context="Addressor"),
    Rule("PatienteninformationExtraction", rf"()({B}{CAPS}(?:-{CAPS})?{S}{CAP})({S},?{S}geb\.?{S})([0-9]{{1,2}}\.[0-9]{{1,2}}\.[0-9]{{2,4}})({S},?{S}Pat-?Nr\.?{S}:?{S})([0-9]+)({S},{S})(\p{{Lu}}\p{{L}}+{S}[0-9]+[a-z]?)({S},{S}(?:CH-)?)([0-9]{{4,5}})({S})({CAP})", ((2, "Name", "patient"), (4, "Date", "DOB"), (6, "ID", "patient ID"), (8, "Location", "street"), (10, "Location", "zip"), (12, "Location", "city")), context="Patienteninformation"),
]

DIAGNOSIS = [
    Rule("SuspectedDiagnosis", rf"({B}(?:Verdacht{S}auf|Vd{S}\.?{S}a{S}\.?)(?:{S}eine?n?)?{S})(\p{{L}}+)", ((2, "Diagnosis", "suspected"),)),
    Rule("RemoveFalsePositiveDiagnosis", rf"({B}\p{{L}}+\"?{S}-?{S}(?:Abklärung|Sprechstunde|SS){E})", ((1, "Diagnosis", ""),), 100, action="delete"),
]

FIELDS = needing(FIELDS, DOBTrigger=("geb",), InternalPhoneTrigger=("Tel", "Sucher"), DetectSignaturesInTags=("<",))
DIAGNOSIS = needing(DIAGNOSIS, SuspectedDiagnosis=("Verdacht", "Vd"), RemoveFalsePositiveDiagnosis=("Abkl", "Sprechstunde", "SS"))
AGE = needing(AGE, (DIGIT,), KidsAge=("Kinder",), AgeYearOfLife=("Lebensjahr",), AgeLeftContextTrigger=("Alter",))
INTERNET = needing(INTERNET, emailaddress=("@",), url=(".info", ".com", ".net", ".org", ".ch", ".de", ".fr", ".li", ".eu"))
CONTACTS = needing(CONTACTS, (DIGIT,), PhoneNumberLeftTrigger=("Tel", "Fax", "Sekretariat"))
IDS = needing(IDS, (DIGIT,), PatnrTrigger=("PatNr",), PatientIDVerlauf=("#",), CaseIDVerlauf=("Fall",), AHVNumber=("756",))
LOCATIONS = needing(
    LOCATIONS,
    LocationLeftTrigger=("Haltestelle",),
    GenericStreetNames=("allee", "gasse", "platz", "strasse", "weg", "str"),
    GenericStreetNamesLeftTrigger=("Rue", "Via"),
    StreetsNamedAfterPeople=("Str",),
    PostalBox=("Postfach",),
    ZipCodeAndCityWithCountry=(DIGIT,),
    HospitalLocation=("pital", "Reha", "Krankenhaus", "KS", "RS"),
    HospitalPostfix=("spital",),
    HospitalUnit=("Klinik", "Institut", "Zentrum", "Abteilung"),
    HospitalUnitRightTriggered=("ologische",),
    HospitalUnitPostfix=("klinik", "institut", "zentrum", "departement"),
    HealthcareOrSocialInstitutions=("raxis", "rzte", "haus", "heim", "Heim", "entrum", "esidenz", "iedlung", "gruppe", "linik", "Permanence", "Homecare", "APH", "PZ", "Beratungsstelle", "Salem", "Spitex", "Tertianum", "Sanatorium"),
    HealthcareOrSocialInstitutionsRightTriggered=("raxis", "klinik", "Klinik", "Wohnheim", "Ärztezentrum"),
    CompanyLeftTriggered=("Firma",),
    Foundations=("Stiftung",),
    FoundationsRightTriggered=("tiftung",),
    DetectLanguages=("Schweizerdeutsch", "sprachig"),
    ConsumeKlinik=("klinik",),
)
BUILDINGS = needing(BUILDINGS, FindBuilding=("NORD",), Stations=("Station",), Rooms=("Zimmer",), Floor=("Stockwerk",), AnnotateZH=("ZH",))
OCCUPATIONS = needing(
    OCCUPATIONS,
    OccupationsLeftTriggered=("Beruf", "gelernte", "Lehre", "Ausbildung"),
    OccupationsRetiredLeftTriggered=("pensionierte",),
    OccupationsWorkTriggered=("arbeitet", "vormalige"),
    OccupationsLeftTriggeredAnamnesis=("ehemals",),
    OccupationsRightTriggered=("tätig", "gearbeitet"),
    OccupationPostfixTriggered=("ftler", "professor", "lehrer", "studium", "tudent", "angestellte"),
)
NAMES = needing(
    NAMES,
    DoctorsLeftContext=("Prof", "PD", "Dr", "pract", "OA", "AA", "UA", "OÄ", "AÄ", "JA"),
    DoctorsRightContext=("arzt", "ärztin", "OA"),
    NursingStaffLeftContext=("PFF",),
    NursingStaffRightContext=("Pflegefach", "dipl", "PFF", "MPA"),
    StaffSurnameEnumerationTriggered=("Anwesend",),
    SimpleDetectPatient=("Herr", "Hr", "Frau", "Fr", "Ehepaar", "Familie"),
    ConsumeMethodAuthorsLeftTrigger=("nach",),
    ConsumeMethodAuthorsRightTrigger=(DIGIT,),
    ConsumeCitations=("et",),
)
