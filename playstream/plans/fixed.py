"""A small forest and a logistic model with given parameters, for scores that
can be checked value by value (the oracle states the same parameters in SQL)."""

from playstream.operators.compiled import Leaf, Split, forest, logistic
from playstream.operators.models import MVP_FEATURES, WIN_FEATURES

FIXED_WIN = forest([
    Split("score_diff", 0.5, Split("seconds_remaining", 1440.5, Leaf(0.125), Leaf(0.375)), Split("score_diff", 9.5, Leaf(0.625), Leaf(0.9375))),
    Split("seconds_remaining", 600.5, Split("score_diff", -3.5, Leaf(0.0), Split("score_diff", 3.5, Leaf(0.5), Leaf(1.0))), Leaf(0.4375)),
    Split("score_diff", -12.5, Leaf(0.03125), Leaf(0.5625)),
], WIN_FEATURES)

FIXED_MVP = logistic(-4.5, [0.11, 0.07, 0.05, 0.21, 0.19, -0.13, -0.08, 0.004, 6.5], MVP_FEATURES)
