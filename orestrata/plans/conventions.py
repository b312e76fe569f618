"""What all series collections share: the cells of an observation and the rules that its rows and a population's must keep.

Every condition is a rule of its own, so that a row in quarantine says which ones it breaks and each is counted singly.
"""
from __future__ import annotations

from orestrata.operators.conform import Cast, Missing, Text
from orestrata.operators.quality import Rule

# The years and the periods (four quarters and the annual average) that series may have.
FIRST_YEAR, LAST_YEAR = 1900, 2200
PERIODS = ("Q01", "Q02", "Q03", "Q04", "Q05")

OBSERVATION_CELLS = (
    Text("series_id"),
    Text("year_text", key="year", trim=False),
    Text("period"),
    Text("value_text", key="value"),
    Text("footnote_codes"),
    Cast("year", of="year_text", to="int"),
    Cast("value", of="value_text", to="decimal(24,6)"),
    Missing("missing_value", of="value_text"),
)


def matches(name: str, column: str, pattern: str, action: str = "drop") -> Rule:
    return Rule(name, rf"{column} RLIKE r'\A(?:{pattern})\z'", action)


def within(name: str, column: str, low: int, high: int) -> Rule:
    return Rule(name, f"{column} BETWEEN {low} AND {high}", "drop")


def one_of(name: str, column: str, values: tuple[str, ...]) -> Rule:
    return Rule(name, f"{column} IN ({', '.join(map(repr, values))})", "drop")


def given(name: str, column: str, unless: str = "FALSE") -> Rule:
    return Rule(name, f"{column} IS NOT NULL OR {unless}", "drop")


def observation_rules(id_pattern: str) -> tuple[Rule, ...]:
    return (
        matches("series_key", "series_id", id_pattern),
        within("year_in_range", "year", FIRST_YEAR, LAST_YEAR),
        one_of("known_period", "period", PERIODS),
        given("value_or_marker", "value", unless="missing_value"),
    )


def population_rules() -> tuple[Rule, ...]:
    return (
        given("nation_named", "nation"),
        within("year_in_range", "year", FIRST_YEAR, LAST_YEAR),
        Rule("people_counted", "population > 0", "drop"),
        Rule("whole_number", "population_decimal = population", "drop"),
    )
