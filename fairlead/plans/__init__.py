"""The models, from staging to marts, the analytic queries and the batch job."""
