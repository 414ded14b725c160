"""Aircraft-fleet star schema and KPI engine on PySpark."""
