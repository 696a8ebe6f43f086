"""The layers: staging, Silver, Gold and the dashboard queries."""
