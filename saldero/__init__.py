"""Sales-KPI engine on Spark: lake, quality gates, star schema and report measures."""
