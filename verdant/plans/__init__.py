"""Query plans: each module registers (Spark builder, oracle SQL) pairs."""

from verdant.plans import q_dashboard, q_keyed, q_points, q_search_geo, q_segments, q_sessions, q_stored  # noqa: F401
from verdant.plans.registry import ORACLE, QUERIES  # noqa: F401
