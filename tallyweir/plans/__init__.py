
from . import format_plans, read_plans, stats_plans, store_plans

QUERIES = read_plans.QUERIES | stats_plans.QUERIES | format_plans.QUERIES | store_plans.QUERIES
ORACLE_SQL = read_plans.SQL | stats_plans.SQL | format_plans.SQL | store_plans.SQL
