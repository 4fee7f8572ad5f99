"""Dates: dotted, slashed, named, partial and ranged, with numbers that only look like one."""

from spanloom.operators.rules import DIGIT, Rule, needing
from spanloom.rulesets.patterns import DAY, MONTH, MONTH_NAME, MONTHS_SHORT, NB, NE, RANGE, TRIGGER, UNIT, YEAR, YEAR2, YEAR4, B, E, S

D, DOB = "Date", "DOB"
ONE = ((2, D, "other"),)
PRE = rf"((?:{TRIGGER}{S})?)"
FORCED = rf"({TRIGGER}{S})"
DOTTED = rf"{NB}{DAY}{S}\.{S}{MONTH}{S}\.{S}{YEAR}"
SLASHED = rf"{NB}{DAY}{S}/{S}{MONTH}{S}/{S}{YEAR}"
NO_YEAR = rf"{NB}{DAY}{S}\.{S}{MONTH}{NE}"
SLASH2 = rf"{NB}{MONTH}{S}/{S}{YEAR2}{NE}"
SURE_SLASH2 = rf"{NB}(?:(?:0[1-9]|1[0-2]){S}/{S}{YEAR2}|[1-9]{S}/{S}0[0-9]){NE}"

RULES = [
    Rule("RegularDotDates", rf"{PRE}({DOTTED}|{SLASHED})", ONE),
    Rule("RegularDotDatesNegativeSlash", rf"{PRE}({SLASHED})({S}{UNIT})"),
    Rule("IsoDates", rf"{PRE}({NB}{YEAR4}-{MONTH}-{DAY}{NE})", ONE),
    Rule("DotDatesNoYear", rf"{PRE}({NO_YEAR}{S}\.)", ONE),
    Rule("DotDatesNoYearWithTime", rf"{PRE}({NO_YEAR}{S}\.)({S}[0-9]{{2}}\.[0-9]{{2}}{S}Uhr)", ONE, 1000),
    Rule("DotDatesNoYearTrigger", rf"{FORCED}({NO_YEAR})", ONE),
    Rule("DotDatesNoYearTriggerNegative", rf"{FORCED}({NO_YEAR})({S}{UNIT})", (), 100),
    Rule("DotDatesNoYearRightTrigger", rf"()({NO_YEAR})({S}(?:um{E}|:|\)))", ONE),
    Rule("MonthNameDate", rf"{PRE}({NB}{DAY}{S}\.{S}{MONTH_NAME}(?:{S}{YEAR})?)", ONE),
    Rule("MonthSlashDate", rf"{PRE}({NB}{MONTH}{S}[/.]{S}{YEAR4}{NE})", ONE, 100),
    Rule("MonthSlashDateTrigger", rf"{PRE}({SURE_SLASH2})", ONE),
    Rule("MonthSlashDateLeftTrigger", rf"((?:{TRIGGER}|{B}(?:\p{{L}}*(?:omie|graphie|opsie)|CT|MRI){E}){S})({SLASH2})", ONE, 200),
    Rule("MonthSlashDateNegativeUnit", rf"{PRE}({SLASH2})({S}{UNIT})", (), 100),
    Rule("MonthSlashDateNegativeScaleTrigger", rf"((?:{B}(?:Th|BWK|VAS|ATS|SUVmax){E}|-){S})({SLASH2})", (), 500),
    Rule("MonthYear", rf"{PRE}({B}{MONTH_NAME}{S}/?{S}{YEAR})", ONE),
    Rule("MonthYearUnspecificDate", rf"({B}(?:Anfang|Mitte|Ende){S})({MONTH_NAME}(?:{S}{YEAR})?)", ONE),
    Rule("EnglishDates", rf"{PRE}({B}{MONTH_NAME}{S}{DAY}{S},?{S}{YEAR4}{NE})", ONE),
    Rule("MonthNameOnly", rf"({B}[Ii]m{S})({MONTH_NAME})(?!{S}\.?{S}[0-9])", ONE),
    Rule("MonthYearNumerical", rf"{PRE}({NB}{MONTH}{S}\.{S}{YEAR4}{NE})", ONE),
    Rule("SingleYear", rf"{PRE}({B}{YEAR4}{E})", ONE),
    Rule("SingleYearNegative", rf"{PRE}({B}{YEAR4})({S}(?:Uhr{E}|{UNIT}))", (), 1000),
    Rule("SingleYearTwoDigits", rf"{FORCED}({B}{YEAR2}{E})", ONE),
    Rule("SingleYearTwoDigitsNegative", rf"{FORCED}({B}{YEAR2})({S}(?:\.|{UNIT}))", (), 1000),
    Rule("BirthYear", rf"({B}Jahrgang{S})({NB}(?:{YEAR4}|[0-9]{{2}}){NE})", ((2, D, DOB),)),
    Rule("ApproximateMonthYear", rf"()({B}{MONTH_NAME})({S}/{S})({MONTH_NAME}{S}{YEAR})", ((2, D, "other"), (4, D, "other"))),
    Rule("DayRange", rf"{PRE}({NB}{DAY}{S}\.(?:{S}{MONTH}{S}\.?)?)({S}{RANGE}{S})({DOTTED})", ((2, D, "other"), (4, D, "other"))),
    Rule("DayRangeNoYears", rf"{FORCED}({NO_YEAR}\.?)({S}{RANGE}{S})({NO_YEAR}\.?)", ((2, D, "other"), (4, D, "other"))),
    Rule("DayRangeNoYearsNegative", rf"()({NO_YEAR}\.?)({S}{RANGE}{S})({NO_YEAR}\.?)({S}{UNIT})", (), 100),
    Rule("DayRangeNoYearsPartialMonths", rf"{FORCED}({NB}{DAY}\.)({S}{RANGE}{S})({NO_YEAR}\.?)", ((2, D, "other"), (4, D, "other"))),
    Rule("YearMonthRange", rf"()({NB}{MONTH}(?:{S}/{S}{YEAR})?)({S}{RANGE}{S})({NB}{MONTH}{S}/{S}{YEAR})", ((2, D, "other"), (4, D, "other"))),
    Rule("YearMonthRangeNegative", rf"()({NB}{MONTH}(?:{S}/{S}{YEAR})?)({S}{RANGE}{S})({NB}{MONTH}{S}/{S}{YEAR})({S}{UNIT})"),
    Rule("YearRange", rf"()({B}{YEAR4})({S}{RANGE}{S}|{S}/{S})({YEAR4}{E}|{YEAR2}{E})", ((2, D, "other"), (4, D, "other"))),
    Rule("YearRangeNegative", rf"()({B}{YEAR4})({S}{RANGE}{S}|{S}/{S})({YEAR4}|{YEAR2})({S}{UNIT})", (), 100),
    Rule("ConsumeCitations", rf"({B}et{S}al{S}\.?{S},?{S})({YEAR4}{NE})", (), 1000),
]

_named = tuple(dict.fromkeys(x for m in MONTHS_SHORT for x in (m[:3], m[:3].lower(), m[:3].upper()))) + ("Mar", "mar", "MAR", "May", "may", "MAY", "Oct", "oct", "OCT", "Dec", "dec", "DEC")
_year, _trigger = ("19", "20"), ("am", "ab", "bis", "den", "dem", "seit", "vom", "Erstdiagnose", "ED", "EM", "ES", "Aufenthalt")
RULES = needing(
    RULES,
    (DIGIT,),
    RegularDotDates=(".", "/"),
    RegularDotDatesNegativeSlash=("/",),
    IsoDates=_year,
    DotDatesNoYear=(".",),
    DotDatesNoYearWithTime=("Uhr",),
    DotDatesNoYearTrigger=(".",),
    DotDatesNoYearTriggerNegative=(".",),
    DotDatesNoYearRightTrigger=(".",),
    MonthNameDate=_named,
    MonthSlashDate=_year,
    MonthSlashDateTrigger=("/",),
    MonthSlashDateLeftTrigger=("/",),
    MonthSlashDateNegativeUnit=("/",),
    MonthSlashDateNegativeScaleTrigger=("/",),
    MonthYear=_named,
    MonthYearUnspecificDate=("Anfang", "Mitte", "Ende"),
    EnglishDates=_named,
    MonthNameOnly=_named,
    MonthYearNumerical=_year,
    SingleYear=_year,
    SingleYearNegative=_year,
    SingleYearTwoDigits=_trigger,
    SingleYearTwoDigitsNegative=_trigger,
    BirthYear=("Jahrgang",),
    ApproximateMonthYear=_named,
    DayRange=(".",),
    DayRangeNoYears=(".",),
    DayRangeNoYearsNegative=(".",),
    DayRangeNoYearsPartialMonths=(".",),
    YearMonthRange=("/",),
    YearMonthRangeNegative=("/",),
    YearRange=_year,
    YearRangeNegative=_year,
    ConsumeCitations=("et",),
)
