"""Council records on Spark: places, meetings, papers, graphs and data quality as DataFrame operators."""
