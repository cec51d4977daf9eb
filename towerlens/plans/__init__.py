"""Plans: silver cleaning, gold marts, data quality, queries, dashboards."""
