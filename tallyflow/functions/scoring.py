"""Interaction scores of single events."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Reading speed, and the actions that are not plain clicks.
WORDS_PER_SECOND = 5.0
FEEDBACK_ACTIONS = ("feedbackmodulewasuseful", "feedbackmodule")
IGNORED_ACTIONS = ("feedbackmodulewasuseful", "feedbackmodule", "carouselswipe", "backbutton")


def scroll_score(depth: Column) -> Column:
    whole = F.floor(depth.try_cast("double"))
    return F.when(whole.isin(25, 50, 75, 100), whole / 10.0).otherwise(0.0)


def reading_score(seconds: Column, words: Column) -> Column:
    """0..10 by the share of the text that could have been read; below a tenth is 0."""
    ratio = seconds * WORDS_PER_SECOND / words
    return (
        F.when((words > 0) & (seconds > 0) & (ratio >= 0.1), F.least(F.ceil(ratio * 10), F.lit(10)))
        .otherwise(0)
        .cast("double")
    )


def feedback_score(useful: Column) -> Column:
    return F.when(useful, 10.0).otherwise(-15.0)


def interest_score(selected: Column, topic: str = "photography") -> Column:
    return F.when(F.array_contains(selected, topic), 50.0).otherwise(-75.0)


def event_score(
    event: Column,
    scroll_depth: Column,
    time_on_page: Column,
    words: Column,
    action: Column,
    feedback: Column,
    selected: Column,
    topic: str = "photography",
) -> Column:
    """One score per event, chosen by its kind; a kind without a rule scores 0."""
    kind = F.lower(event)
    click = kind == "contentitem_click"
    return (
        F.when(kind.isin("contentitem_received", "contentitem_view"), 1.0)
        .when(kind == "contentitem_pagescroll", scroll_score(scroll_depth))
        .when(kind == "contentitem_timeonpage", reading_score(time_on_page, words))
        .when(click & action.isin(*FEEDBACK_ACTIONS) & feedback.isNotNull(), feedback_score(feedback))
        .when(click & action.isNotNull() & ~action.isin(*IGNORED_ACTIONS), 1.0)
        .when(kind == "timeline_onboardingmessage_click", interest_score(F.coalesce(selected, F.array().cast("array<string>")), topic))
        .otherwise(0.0)
    )
