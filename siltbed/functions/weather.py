"""Conditions on weather values as Column expressions: names of variables, words for conditions and comparisons."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Names that a variable goes by, and words that stand for a condition.
VARIABLES = {
    "temperature_2m_mean": ("temperature", "temperature_2m", "temp", "温度"), "precipitation_sum": ("precipitation", "rain", "rainfall", "降水", "降雨"),
    "weather_code": ("weather", "weathercode", "天气", "天气现象"), "cloud_cover": ("cloud", "clouds", "云量", "云图", "cloud_fraction", "cloud_cover_fraction"), "visibility": ("能见度",),
    "wind_speed_10m": ("wind", "wind_speed", "风", "风速"), "snowfall_sum": ("snowfall", "snow", "降雪"), "snow_depth": ("积雪深度",),
    "snow_cover_fraction": ("snow_cover", "ndsi", "积雪", "积雪覆盖", "积雪范围"),
}
WORDS = {"cloud_cover < 20": ("clear", "晴", "少云"), "snowfall_sum > 0": ("snow", "雪", "下雪", "有雪")}
#: What stands in for a variable that is not there.
INSTEAD = {"snowfall_sum": ("snowfall", "snow_depth"), "precipitation_sum": ("precipitation", "rain")}
COMPARED = r"^([^<>=]*[^<>=\s])\s*(<=|>=|==|=|<|>)\s*(-?[0-9]+(?:\.[0-9]+)?)$"


def canonical(name: Column) -> Column:
    """The name by which values go; an unknown one stays as it is."""
    known = F.create_map(*[F.lit(x) for own, names in VARIABLES.items() for other in names for x in (other, own)])
    return F.coalesce(F.try_element_at(known, F.lower(F.trim(name))), F.trim(name))


def satisfied(values: Column, condition: Column) -> Column:
    """Whether values (map of names to numbers) fit a condition: a word for one, or a comparison of a variable with a number.

    Null where the condition is neither, where its variable is not among the values, or where its value is null.
    """
    text = F.trim(condition)
    words = F.create_map(*[F.lit(x) for told, names in WORDS.items() for name in names for x in (name, told)])
    told = F.coalesce(F.try_element_at(words, F.lower(text)), text)
    name, op = (F.regexp_extract(told, COMPARED, i) for i in (1, 2))
    number = F.nullif(F.regexp_extract(told, COMPARED, 3), F.lit("")).try_cast("double")
    own = canonical(name)
    value = F.coalesce(F.try_element_at(values, own), F.try_element_at(values, F.trim(name)))
    for variable, others in INSTEAD.items():
        for other in others:
            value = F.coalesce(value, F.when((own == variable) & ~F.map_contains_key(values, F.lit(variable)), F.try_element_at(values, F.lit(other))))
    return (
        F.when(op == "<", value < number).when(op == ">", value > number).when(op == "<=", value <= number).when(op == ">=", value >= number)
        .when(op.isin("=", "=="), value == number)
    )
