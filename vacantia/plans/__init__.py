"""Plans from landed payloads to normalised tables, by source."""

from vacantia.plans import amazon, apple, dice, facebook, indeed
from vacantia.plans.amazon import classify_amazon, normalise_amazon
from vacantia.plans.apple import classify_apple, normalise_apple
from vacantia.plans.companies import flatten_companies
from vacantia.plans.dice import classify_dice, normalise_dice
from vacantia.plans.facebook import classify_facebook, normalise_facebook
from vacantia.plans.indeed import classify_indeed, normalise_indeed

PLANS = {m.SOURCE: m.PLAN for m in (amazon, apple, facebook, dice, indeed)}
#: Sources whose stored ids keep a posting from being taken twice; the others are collected afresh.
KEEPS_IDS = ("apple", "facebook", "dice", "indeed")
AGGREGATORS = ("dice", "indeed")

__all__ = [
    "AGGREGATORS", "KEEPS_IDS", "PLANS", "classify_amazon", "classify_apple", "classify_dice",
    "classify_facebook", "classify_indeed", "flatten_companies", "normalise_amazon",
    "normalise_apple", "normalise_dice", "normalise_facebook", "normalise_indeed",
]
