"""Pure Column expressions. Nothing here triggers a Spark job."""
