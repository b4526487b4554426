"""Names and codes that results depend on."""

# Service name by product code; '' is a listed code without a name.
PRODUCT_CODE_NAMES = {
    "AmazonApiGateway": "Amazon API Gateway",
    "AmazonAthena": "Amazon Athena",
    "AmazonCloudFront": "Amazon CloudFront",
    "AmazonCloudWatch": "AmazonCloudWatch",
    "AmazonCognito": "Amazon Cognito",
    "AmazonDocDB": "Amazon DocumentDB (with MongoDB compatibility)",
    "AmazonDynamoDB": "Amazon DynamoDB",
    "AmazonEC2": "Amazon Elastic Compute Cloud",
    "AmazonECR": "Amazon EC2 Container Registry (ECR)",
    "AmazonECRPublic": "Amazon Elastic Container Registry Public",
    "AmazonECS": "Amazon Elastic Container Service",
    "AmazonEFS": "Amazon Elastic File System",
    "AmazonEKS": "Amazon Elastic Container Service for Kubernetes",
    "AmazonElastiCache": "Amazon ElastiCache",
    "AmazonES": "Amazon Elasticsearch Service",
    "AmazonForecast": "Amazon Forecast",
    "AmazonGlacier": "",
    "AmazonGuardDuty": "Amazon GuardDuty",
    "AmazonInspector": "Amazon Inspector",
    "AmazonKinesis": "Amazon Kinesis",
    "AmazonKinesisAnalytics": "Amazon Kinesis Analytics",
    "AmazonKinesisFirehose": "Amazon Kinesis Firehose",
    "AmazonLightsail": "Amazon Lightsail",
    "AmazonMCS": "",
    "AmazonMQ": "",
    "AmazonMSK": "Amazon Managed Streaming for Apache Kafka",
    "AmazonMWAA": "Amazon Managed Workflows for Apache Airflow",
    "AmazonNeptune": "Amazon Neptune",
    "AmazonPersonalize": "Amazon Personalize",
    "AmazonPolly": "Amazon Polly",
    "AmazonQuickSight": "Amazon QuickSight",
    "AmazonRDS": "Amazon Relational Database Service",
    "AmazonRedshift": "Amazon Redshift",
    "AmazonRekognition": "Amazon Rekognition",
    "AmazonRoute53": "Amazon Route 53",
    "AmazonS3": "Amazon Simple Storage Service",
    "AmazonS3GlacierDeepArchive": "Amazon S3 Glacier Deep Archive",
    "AmazonSageMaker": "Amazon SageMaker",
    "AmazonSES": "Amazon Simple Email Service",
    "AmazonSimpleDB": "Amazon SimpleDB",
    "AmazonSNS": "Amazon Simple Notification Service",
    "AmazonStates": "",
    "AmazonTimestream": "Amazon Timestream",
    "AmazonVPC": "Amazon Virtual Private Cloud",
    "AmazonWorkDocs": "Amazon WorkDocs",
    "AmazonWorkSpaces": "Amazon WorkSpaces",
    "AppFlow": "Amazon AppFlow",
    "AWSAmplify": "AWS Amplify",
    "AWSAppSync": "AWS AppSync",
    "AWSBackup": "AWS Backup",
    "AWSBudgets": "AWS Budgets",
    "AWSCertificateManager": "AWS Certificate Manager",
    "AWSCloudShell": "AWS CloudShell",
    "AWSCloudTrail": "AWS CloudTrail",
    "AWSCodeArtifact": "AWS CodeArtifact",
    "AWSCodeCommit": "AWS CodeCommit",
    "AWSCodePipeline": "AWS CodePipeline",
    "AWSConfig": "AWS Config",
    "AWSCostExplorer": "AWS Cost Explorer",
    "AWSDatabaseMigrationSvc": "AWS Database Migration Service",
    "AWSDataTransfer": "AWS Data Transfer",
    "AWSDirectoryService": "AWS Directory Service",
    "AWSELB": "Elastic Load Balancing",
    "AWSElementalMediaConvert": "AWS Elemental MediaConvert",
    "AWSElementalMediaLive": "AWS Elemental MediaLive",
    "AWSElementalMediaPackage": "AWS Elemental MediaPackage",
    "AWSElementalMediaStore": "",
    "AWSElementalMediaTailor": "AWS Elemental MediaTailor",
    "AWSEvents": "",
    "AWSGlobalAccelerator": "AWS Global Accelerator",
    "AWSGlue": "AWS Glue",
    "awskms": "AWS Key Management Service",
    "AWSLambda": "AWS Lambda",
    "AWSQueueService": "Amazon Simple Queue Service",
    "AWSSecretsManager": "AWS Secrets Manager",
    "AWSSecurityHub": "AWS Security Hub",
    "AWSShield": "AWS Shield",
    "AWSSystemsManager": "AWS Systems Manager",
    "AWSTransfer": "AWS Transfer Family",
    "awswaf": "AWS WAF",
    "AWSXRay": "AWS X-Ray",
    "CodeBuild": "",
    "comprehend": "Amazon Comprehend",
    "ComputeSavingsPlans": "Savings Plans for AWS Compute usage",
    "datapipeline": "AWS Data Pipeline",
    "ElasticMapReduce": "Amazon Elastic MapReduce",
    "OCBElasticComputeCloud": "",
    "OCBPremiumSupport": "",
    "translate": "Amazon Translate",
}

DATA_TRANSFER = "AWS Data Transfer"
MARKETPLACE = "AWS Marketplace"

# Codes that get their full name when a line has no service name.
UNNAMED_SERVICE_CODES = ("AmazonEC2", "AmazonRedshift", "AmazonElastiCache", "AmazonRDS")

# A line with this code, no service name and type Fee is named by its code.
CODE_NAMED_FEE = "OCBElasticComputeCloud"

RUNNING_USAGE_TYPES = ("DiscountedUsage", "SavingsPlanCoveredUsage", "Usage")

# Charge types the "amortized" reports leave out.
NON_USAGE_CHARGES = ("Refund", "Credit", "Tax", "Fee")

MASKED_DESCRIPTION = "Masked description"
MASKED_AMOUNT = 0.01

# Usage type pattern, product name pattern (None: any product).
MASKED_USAGE = (
    ("%TimedStorage-ByteHrs%", "%Amazon Simple Storage Service%"),
    ("%TimedStorage-GlacierByteHrs%", "%Amazon Simple Storage Service%"),
    ("%-Requests-HTTP-Proxy", "%CloudFront%"),
    ("%-Requests-HTTPS-Proxy", "%CloudFront%"),
    ("%-DataTransfer-Out-Bytes", "%CloudFront%"),
    ("%DataTransfer-Regional-Bytes", None),
)

# Charge type and description of a discount that is masked.
MASKED_REFUND = ("Refund", "Enterprise Program Discount")

# Services of the commitment series.
COMMITMENT_SERVICES = ("AMAZON EC2", "AMAZON RDS", "AMAZON REDSHIFT", "AMAZON ELASTICACHE")
