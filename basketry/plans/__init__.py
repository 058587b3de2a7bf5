"""Business reports, dashboard panels and the warehouse build."""
